"""Customer-contact and marketing analytics as lazy PySpark DataFrame operators."""

"""All registered queries: importing the modules registers them."""

from checks import operators_a, operators_b, relational, reports  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

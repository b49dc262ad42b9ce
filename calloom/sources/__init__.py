from calloom.sources.tables import Tables, duplicate_keys, read_report, refresh_report, write_report

__all__ = ["Tables", "duplicate_keys", "read_report", "refresh_report", "write_report"]

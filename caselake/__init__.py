"""Case-surveillance analytics on PySpark: files to star schema, events to counters."""

__version__ = "0.1.0"

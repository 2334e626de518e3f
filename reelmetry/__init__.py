"""Frame-stream and operational-metric analytics on PySpark."""

__version__ = "0.1.0"

"""nightframe: instrument-data reduction as Spark DataFrame jobs."""

__version__ = "0.1.0"

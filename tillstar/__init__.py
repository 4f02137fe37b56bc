"""tillstar: raw retail tables to an analytical star schema, as Spark jobs."""

__version__ = "0.1.0"

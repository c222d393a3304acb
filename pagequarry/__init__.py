"""Search and link analysis over a table of web pages, as Spark jobs."""

__version__ = "0.1.0"

"""Data jobs for review, customer and text records on Spark.

Every transform is a function from DataFrame to DataFrame, so the same code serves a bounded table
and a Structured Streaming source.
"""

__version__ = "0.1.0"

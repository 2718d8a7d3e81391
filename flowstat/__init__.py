"""flowstat: e-commerce behaviour analytics as PySpark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or a tuple of
DataFrames for operators with side outputs) whose column names and durations
are parameters.  Batch and Structured Streaming inputs share the same
functions wherever Spark allows it; streaming-only forms live in
``flowstat.streaming``.
"""

__version__ = "0.1.0"

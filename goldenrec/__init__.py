"""goldenrec: record deduplication and golden-record selection on Spark.

Every operator is a function from DataFrame to DataFrame (or a Column
expression) built from Spark's own expressions, so the same code runs in
batch jobs, in Structured Streaming and on any cluster size.
"""

__version__ = "0.1.0"

"""demandlab: demand analytics over trip-like events, written for Spark.

Every operator takes DataFrames and returns a DataFrame, so the pieces chain
with ``df.transform`` and run unchanged on a laptop or a cluster.
"""

__version__ = "0.1.0"

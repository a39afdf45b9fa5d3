"""recfold: Spark-native offline recommendation analytics.

Every operator is a function from DataFrames to a DataFrame built on Spark SQL
and MLlib. Nothing in the core collects data to the driver; the few places that
broadcast a dimension (the item catalogue for top-K scoring) check its size
first and fall back to a blocked plan beyond the bound.
"""

__version__ = "0.1.0"

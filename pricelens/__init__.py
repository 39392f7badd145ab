"""pricelens: Spark-native tabular regression analytics.

Every capability is a DataFrame -> DataFrame operator built from Spark SQL
expressions, grouped/windowed aggregations and ``pyspark.ml`` stages.
Randomness comes only from hashes of row keys (``functions.portable``), so
results do not depend on partitioning or executor count.
"""

__version__ = "0.1.0"

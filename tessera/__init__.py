"""tessera: Spark-native preparation, balancing, scoring and evaluation of
labelled tabular and per-subject series data.

Every public operator takes DataFrames and returns DataFrames (or a small,
driver-sized fitted state whose size is O(features), never O(rows)).
"""

__version__ = "0.1.0"

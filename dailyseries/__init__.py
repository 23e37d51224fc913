"""dailyseries: keyed daily-series features and binary scoring on Spark.

Every operator takes and returns a ``pyspark.sql.DataFrame``; the work is
expressed with DataFrame expressions, windows and aggregations so Catalyst
plans it and the executors run it.
"""

from dailyseries.session import checkpoint_dir, get_session

__all__ = ["checkpoint_dir", "get_session"]

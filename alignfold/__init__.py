"""alignfold: chat / preference data preparation, scoring and evaluation on Spark.

Every operator takes and returns ordinary DataFrames (or Columns). Planning,
shuffling and state are left to Spark; nothing here runs a query on its own.
"""

from alignfold.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]

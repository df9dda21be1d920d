"""cyclewise — equipment-health analytics on panels of sensor time series, on Spark.

A panel is a DataFrame keyed by a unit column and ordered by a cycle column.
Every operator is a DataFrame -> DataFrame function (or a Spark ML stage) and
leaves physical planning to Catalyst/AQE.
"""

from cyclewise.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]

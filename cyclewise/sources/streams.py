"""Replay a table as an ordered file stream (test and demo source for Structured Streaming).

Rows are written slice by slice (e.g. one slice per day), each slice in its own
append job so file modification times follow slice order; inside a slice rows
are hash-partitioned by unit, so one unit's rows of a slice sit in one file.
A file stream with ``maxFilesPerTrigger`` then delivers every unit's rows in
time order. The table is written once, a folder per slice; each slice job reads its folder alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def replay_as_files(df: DataFrame, path: str, slice_col: str, unit: str,
                    files_per_slice: int = 4) -> int:
    """Write ``df`` under ``path`` slice by slice; returns the number of slices."""
    spark = df.sparkSession
    staged = scratch_path(spark, "slices")
    df.repartition(slice_col, F.pmod(F.xxhash64(unit), F.lit(files_per_slice))) \
        .write.partitionBy(slice_col).parquet(staged)
    table = spark.read.schema(df.schema).parquet(staged)
    slices = [r[0] for r in table.select(slice_col).distinct().orderBy(slice_col).collect()]
    for s in slices:
        table.filter(F.col(slice_col) == F.lit(s)).drop(slice_col) \
            .repartition(files_per_slice, unit).write.mode("append").parquet(path)
    return len(slices)

"""Skew-safe positional index within each unit.

``row_number() OVER (PARTITION BY unit ORDER BY ...)`` puts a whole unit in one
task; a unit holding a third of all rows would then be one third of the job in
a single task. Here rows are range-partitioned on (unit, order): the cuts come from
a sample of the keys, so a unit of any length, or one with all its rows on one day, is
spread over as many partitions as its rows need. The sorted partitions are written once
(checkpoint), which numbers every row in the global order; the rows that a unit has in
each partition are counted and become offsets on that small table (a row per unit and
one more per partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.session import reliable_checkpoint


def time_bucket(col: str, seconds: int) -> Column:
    """Monotone bucket of a timestamp column (width in seconds)."""
    return F.floor(F.unix_micros(F.col(col).cast("timestamp")) / F.lit(seconds * 1_000_000))


def value_bucket(col: str, width: float) -> Column:
    """Monotone bucket of a numeric column."""
    return F.floor(F.col(col) / F.lit(width))


def with_position(df: DataFrame, unit: str, order: list[str | Column], bucket: Column | None = None,
                  out: str = "_pos", total_out: str | None = None) -> DataFrame:
    """Add ``out`` = 1-based row position of each row within its unit, by ``order``.

    The result equals ``row_number()`` over the unit (``bucket`` is not needed any more).
    ``total_out`` optionally adds the unit's row count (= its last position),
    taken from the same small offsets table at no extra pass over the data.
    """
    r = ranged(df, [unit, *order], "_at")
    part = F.shiftright("_at", 33)  # monotonically_increasing_id: partition, then row
    counts = r.groupBy(F.col(unit).alias("_u"), part.alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_u").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("_n").over(Window.partitionBy("_u")).alias(total_out)] if total_out else []
    o = counts.select("_u", "_p", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1)
                      .alias("_off"), *extra)
    j = r.join(o, F.col(unit).eqNullSafe(F.col("_u")) & (part == F.col("_p")))
    cols = [c for c in df.columns if c != out]
    return j.select(*cols, (F.col("_at") + F.col("_off")).cast("long").alias(out),
                    *([total_out] if total_out else []))


def ranged(df: DataFrame, order: list[str | Column], at: str) -> DataFrame:
    """The rows in range partitions sorted by ``order``, written once, with a number ``at`` that
    grows in that order over all partitions."""
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return reliable_checkpoint(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(
        at, F.monotonically_increasing_id()))


def range_scan(df: DataFrame, order: list[str], sums: list[str] = (), carries: list[str] = (),
               parts: int | None = None) -> DataFrame:
    """Exclusive prefix scans over a table in the global ``order`` without a single task.

    For each row adds ``_pre_{c}`` = sum of ``c`` over all earlier rows (for ``sums``),
    ``_prev_{c}`` = last non-null ``c`` of an earlier row and ``_next_{c}`` = first
    non-null ``c`` of a later row (for ``carries``).

    Two passes: rows are range-partitioned on ``order`` (pinned with a checkpoint so
    both passes see the same partition ids), scanned inside each partition, and
    the per-partition totals — one row per partition, bounded by ``parts`` — are
    scanned once and joined back.
    """
    spark = df.sparkSession
    n = parts or max(spark.sparkContext.defaultParallelism, 2)
    r = reliable_checkpoint(
        df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid").orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(1, Window.unboundedFollowing)
    key = F.struct(*[F.col(c) for c in order])
    local = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_lp_{c}") for c in sums]
    for c in carries:
        local += [F.last(c, ignorenulls=True).over(before).alias(f"_lb_{c}"),
                  F.first(c, ignorenulls=True).over(after).alias(f"_la_{c}")]
    per = [F.sum(c).alias(f"_t_{c}") for c in sums]
    for c in carries:
        nn = F.when(F.col(c).isNotNull(), key)
        per += [F.max_by(c, nn).alias(f"_tl_{c}"), F.min_by(c, nn).alias(f"_tf_{c}")]
    wp = Window.orderBy("_pid")  # one row per range partition
    pb = wp.rowsBetween(Window.unboundedPreceding, -1)
    pa = wp.rowsBetween(1, Window.unboundedFollowing)
    tot = r.groupBy("_pid").agg(*per)
    carry = [F.coalesce(F.sum(f"_t_{c}").over(pb), F.lit(0)).alias(f"_cp_{c}") for c in sums]
    for c in carries:
        carry += [F.last(f"_tl_{c}", ignorenulls=True).over(pb).alias(f"_cb_{c}"),
                  F.first(f"_tf_{c}", ignorenulls=True).over(pa).alias(f"_ca_{c}")]
    tot = tot.select("_pid", *carry)
    out = r.select("*", *local).join(F.broadcast(tot), "_pid")
    res = {}
    for c in sums:
        res[f"_pre_{c}"] = F.col(f"_lp_{c}") + F.col(f"_cp_{c}")
    for c in carries:
        res[f"_prev_{c}"] = F.coalesce(F.col(f"_lb_{c}"), F.col(f"_cb_{c}"))
        res[f"_next_{c}"] = F.coalesce(F.col(f"_la_{c}"), F.col(f"_ca_{c}"))
    drop = ["_pid"] + [f"_lp_{c}" for c in sums] + [f"_cp_{c}" for c in sums]
    for c in carries:
        drop += [f"_lb_{c}", f"_la_{c}", f"_cb_{c}", f"_ca_{c}"]
    return out.withColumns(res).drop(*drop)


def with_global_position(df: DataFrame, order: list[str | Column], bucket: Column,
                         out: str = "_pos", total_out: str | None = None) -> DataFrame:
    """1-based position of each row in the global ``order`` (no unit), distributed.

    ``bucket`` must be monotone in ``order``. Row counts per bucket are pre-aggregated,
    prefix-summed with ``range_scan`` (never one task) and joined back; the final
    ``row_number`` runs per bucket. ``total_out`` adds the table's row count (one
    number, taken from the same small count table).
    """
    b = df.withColumn("_bkt", bucket)
    counts = reliable_checkpoint(b.groupBy("_bkt").agg(F.count(F.lit(1)).alias("_n")))
    offs = range_scan(counts, ["_bkt"], sums=["_n"]).select(
        F.col("_bkt").alias("_b"), F.col("_pre__n").alias("_off"))
    j = b.join(offs, b["_bkt"].eqNullSafe(offs["_b"])).drop("_b")
    w = Window.partitionBy("_bkt").orderBy(*order)
    res = j.withColumn(out, (F.row_number().over(w) + F.col("_off")).cast("long"))
    if total_out:
        n = counts.agg(F.sum("_n")).first()[0] or 0
        res = res.withColumn(total_out, F.lit(int(n)).cast("long"))
    return res.drop("_bkt", "_off")

"""Train/test splits.

``hash_split``: a row-stable seeded split — each row's side depends only on a
hash of (seed, key), so it is reproducible across runs, partitionings and
engines, needs no shuffle, and survives executor loss (recomputation gives the
same answer). ``exact=True`` ranks rows by that hash to take exactly
ceil(test_size * n) test rows; the rank is distributed (hash buckets ->
per-bucket counts -> offsets), never a single-task sort.

``tail_split``: the last ``test_size`` share of rows, table-wide in
(unit, cycle) order or per unit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclewise.operators.position import value_bucket, with_global_position, with_position
from cyclewise.schema import CYCLE, SEED, TEST_SIZE, UNIT

HASH_BUCKET_BITS = 20  # rank buckets: hash >> 12 -> up to 2^20 buckets


def split_hash(keys: list[str], seed: int = SEED) -> Column:
    """First 32 bits of md5(seed|key...) as a non-negative long."""
    k = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in keys])
    return F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("long")


def split_hash_sql(keys: list[str], seed: int = SEED) -> str:
    """DuckDB twin of ``split_hash``."""
    k = ", ".join([f"'{seed}'"] + [f"CAST({c} AS VARCHAR)" for c in keys])
    return f"CAST(('0x' || substr(md5(concat_ws('|', {k})), 1, 8)) AS BIGINT)"


def hash_split(df: DataFrame, keys: list[str], test_size: float = TEST_SIZE, seed: int = SEED,
               out: str = "split", exact: bool = False) -> DataFrame:
    """Add ``out`` = 'test' / 'train'."""
    h = split_hash(keys, seed)
    if not exact:
        cut = round(test_size * (1 << 32))  # of the 32-bit hash, so any fraction is met
        return df.withColumn(out, F.when(h < cut, F.lit("test")).otherwise(F.lit("train")))
    d = df.withColumn("_h", h)
    r = with_global_position(d, ["_h", *keys], F.shiftright(F.col("_h"), 32 - HASH_BUCKET_BITS),
                             out="_rank", total_out="_n")
    return r.withColumn(out, F.when(F.col("_rank") <= F.ceil(F.col("_n") * F.lit(test_size)),
                                    F.lit("test")).otherwise(F.lit("train"))) \
        .drop("_h", "_rank", "_n")


def tail_split(df: DataFrame, test_size: float = TEST_SIZE, scope: str = "table",
               unit: str = UNIT, cycle: str = CYCLE, out: str = "split",
               block_rows: int = 1 << 18) -> DataFrame:
    """Unshuffled split: the first floor(n * (1 - test_size)) rows are train.

    ``table``: n and row order over the whole table, ordered by (unit, cycle).
    ``unit``: per unit. Positions come from the skew-safe ranking.
    """
    keep = 1.0 - test_size
    if scope == "unit":
        r = with_position(df, unit, [cycle], value_bucket(cycle, block_rows), out="_rank",
                          total_out="_n")
    else:
        bkt = F.struct(F.col(unit), F.floor(F.col(cycle) / F.lit(block_rows)))
        r = with_global_position(df, [unit, cycle], bkt, out="_rank", total_out="_n")
    return r.withColumn(out, F.when(F.col("_rank") <= F.floor(F.col("_n") * F.lit(keep)),
                                    F.lit("train")).otherwise(F.lit("test"))) \
        .drop("_rank", "_n")


def exact_test_rows(n: int, test_size: float = TEST_SIZE) -> int:
    return math.ceil(n * test_size)

"""Sharding by weighted rendezvous hashing.

Every (record key, shard) pair draws an exponential variate -ln(u) / weight from a 64-bit
hash; the record goes to the shard with the least. A shard's draws do not depend on the
other shards, so one more shard takes rows only into itself and a removed one gives away
only its own rows. A record's shard is decided by its key and the shard weights alone.

Slots number the rows of a shard without gaps. No task holds a shard: rows are counted per
(shard, hash bucket), the counts become offsets on that small table, and only the rows of
one bucket are ordered together. Identical rows are one counted row until the end, so a
row that is repeated very often costs no task more than its copies.

Defined cases: rows with a null key share one key; a null text has no bytes; an empty table
gives an empty result; equal rows get different slots; input columns named like an output
column, in any case, are replaced by it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

BUCKETS = 4096
MADE = {"shard", "grown_shard", "slot"}


def _least(key: Column, weights: list[float]) -> Column:
    """Index of the shard with the least draw; ties go to the lower index."""
    def draw(k: int, w: float) -> Column:
        h = F.xxhash64(key, F.lit(k))
        u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) * F.lit(2.0 ** -53)
        return F.struct((-F.log(u) / F.lit(float(w))).alias("d"), F.lit(k).alias("k"))

    draws = [draw(k, w) for k, w in enumerate(weights)]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["k"]


def shard_column(key: str | Column, weights: int | list[float]) -> Column:
    """Shard of a record: ``weights`` is a number of equal shards or one weight per shard."""
    w = [1.0] * weights if isinstance(weights, int) else [float(x) for x in weights]
    if not w or min(w) <= 0 or not all(math.isfinite(x) for x in w):
        raise ValueError("shard weights are positive numbers")
    key = F.col(f"`{key}`") if isinstance(key, str) else key
    return _least(F.coalesce(key.cast("string"), F.lit("")), w)


def shard_documents(docs: DataFrame, key: str = "doc_id", weights: int | list[float] = 40,
                    buckets: int = BUCKETS) -> DataFrame:
    """All columns of ``docs`` plus shard, grown_shard (the shard with one more, of mean weight)
    and slot: 0, 1, 2, ... within each shard, in the order of the rows' hashes.

    Equal rows meet once, by a SHA-256 of all their columns, which also orders them; counts and
    offsets follow on hashes alone and come back to the rows by the same hash."""
    w = [1.0] * weights if isinstance(weights, int) else list(weights)
    grown = [*w, sum(w) / len(w)]
    kept = [(k, c) for k, c in enumerate(docs.columns) if c.lower() not in MADE]
    plain = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    whole = F.struct(*[F.col(f"_{k}") for k, _ in kept])
    of = F.col(f"_{docs.columns.index(key)}")
    hashed = plain.select(
        F.unhex(F.sha2(F.to_json(whole).cast("binary"), 256)).alias("__h"), whole.alias("__row"),
        shard_column(of, w).alias("__shard"), shard_column(of, grown).alias("__grown"))
    light = hashed.groupBy("__h").agg(F.count(F.lit(1)).alias("__n"), F.first("__shard").alias("__shard"))
    light = light.withColumn("__bucket", F.pmod(F.xxhash64("__h"), F.lit(buckets)).cast("int"))
    counts = light.groupBy("__shard", "__bucket").agg(F.sum("__n").alias("__rows"))
    before = Window.partitionBy("__shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("__shard", "__bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__shard", "__bucket").orderBy("__h").rowsBetween(Window.unboundedPreceding, -1)
    placed = light.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0))).join(
        counts, ["__shard", "__bucket"]).select(
        F.col("__h").alias("__of"), "__n", (F.col("__offset") + F.col("__inside")).alias("__first"))
    # the only shuffle of whole rows; copies meet before it
    rows = hashed.groupBy("__h").agg(*[F.first(c).alias(c) for c in ("__row", "__shard", "__grown")]).join(
        placed, F.col("__h") == F.col("__of"))
    return rows.select(
        *[F.col(f"__row._{k}").alias(c) for k, c in kept], F.col("__shard").alias("shard"),
        F.col("__grown").alias("grown_shard"),
        F.explode(F.sequence(F.col("__first"), F.col("__first") + F.col("__n") - 1)).alias("slot"))


def document_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + F.lit(16)).cast(T.LongType())


def text_crc32(text: str = "text") -> Column:
    return F.crc32(F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8"))

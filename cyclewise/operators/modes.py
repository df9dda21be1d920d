"""Most frequent value of columns, exact, without a buffer of all values.

1. Every task keeps a Misra-Gries summary of at most ``CAPACITY`` values per column; summaries add
   up (Agarwal et al., 2012). A value's summed count is at most its true count, and less by no more
   than the summed error E of the summaries.
2. With M the largest summed count, only values with a summed count of M - E or more can be the
   mode, if M > E; a value in no summary has at most E. These few are counted exactly.
3. Where M <= E the column has no heavy hitter that would prove anything: all its values are
   counted, as ordinary partial aggregates.

Nulls count nowhere; of values that are equally frequent the least wins, in the column's own order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.session import reliable_checkpoint

CAPACITY = 4096


def shrink(counts: dict[str, int], capacity: int) -> tuple[dict[str, int], int]:
    """A summary of at most ``capacity`` values, and by how much its counts are lower."""
    if len(counts) <= capacity:
        return counts, 0
    cut = int(np.partition(np.fromiter(counts.values(), np.int64), len(counts) - capacity - 1)[len(counts) - capacity - 1])
    return {v: n - cut for v, n in counts.items() if n > cut}, cut


def _summaries(width: int, capacity: int):
    """Rows (col, value, n) of a task's summaries; a null value holds the column's error."""
    def run(batches):
        held: list[dict[str, int]] = [{} for _ in range(width)]
        error = [0] * width
        for batch in batches:
            for k in range(width):
                for x in batch.column(k).drop_null().value_counts().to_pylist():
                    held[k][x["values"]] = held[k].get(x["values"], 0) + x["counts"]
                held[k], cut = shrink(held[k], capacity)
                error[k] += cut
        for k in range(width):
            values, n = list(held[k]), list(held[k].values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * (len(n) + 1), pa.int32()), pa.array([*values, None], pa.string()),
                 pa.array([*n, error[k]], pa.int64())], names=["col", "value", "n"])
    return run


def column_modes(df: DataFrame, cols: list[str], capacity: int = CAPACITY) -> dict[str, object]:
    """{column: its mode}, without columns that hold no value. One small row per column reaches the
    driver."""
    if not cols:
        return {}
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{k}") for k, c in enumerate(cols)])
    seen = reliable_checkpoint(
        texts.mapInArrow(_summaries(len(cols), capacity), "col int, value string, n long")
        .groupBy("col", "value").agg(F.sum("n").alias("n")))
    bounds = {r["col"]: (r["m"], r["e"]) for r in seen.groupBy("col").agg(
        F.max(F.when(F.col("value").isNotNull(), F.col("n"))).alias("m"),
        F.max(F.when(F.col("value").isNull(), F.col("n"))).alias("e")).collect()}
    proven = [k for k, (m, e) in bounds.items() if m is not None and m > e]
    open_ = [k for k, (m, e) in bounds.items() if (m is None and e) or (m is not None and m <= e)]
    if not proven and not open_:
        return {}

    def long(keys):
        return texts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("col"), F.col(f"c{k}").alias("value"))
                                                for k in keys])).alias("x")).select("x.col", "x.value").where(
            "value IS NOT NULL")

    counted = None
    if proven:
        least = F.create_map(*[F.lit(x) for k in proven for x in (k, bounds[k][0] - bounds[k][1])])
        few = seen.where(F.col("col").isin(proven) & F.col("value").isNotNull()
                         & (F.col("n") >= least[F.col("col")])).select("col", "value")
        counted = long(proven).join(few, ["col", "value"], "left_semi").groupBy("col", "value").count()
    if open_:
        rest = long(open_).groupBy("col", "value").count()
        counted = rest if counted is None else counted.unionByName(rest)
    counted = reliable_checkpoint(counted)
    out = {}
    for k in sorted(proven + open_):
        kind = df.schema[cols[k]].dataType
        top = counted.where(F.col("col") == k).select("count", F.col("value").cast(kind).alias("v")).orderBy(
            F.desc("count"), "v").first()
        out[cols[k]] = top["v"]
    return out

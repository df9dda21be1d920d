"""Null repair along the cycle axis.

``scope="unit"``: forward fill, then backward fill, within each unit.
``scope="table"``: the same across the whole table in (unit, cycle) order, so a
unit's leading nulls take the previous unit's last value.

Skew-safe form: rows are cut into (unit, block) groups of at most
``block_rows``. Inside a group, ``last``/``first`` with ``ignorenulls`` fill
from neighbours; the value to carry across group boundaries comes from a small
per-group summary (last/first non-null value per group), scanned with a window
over that summary only and joined back. No task sees more than one block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.operators.modes import column_modes
from cyclewise.operators.position import range_scan, value_bucket, with_position
from cyclewise.schema import CYCLE, NUMERIC_FILL, STRING_FILL, UNIT

DEFAULT_BLOCK_ROWS = 1 << 18


def fill_nulls(df: DataFrame, cols: list[str], scope: str = "unit", unit: str = UNIT,
               cycle: str = CYCLE, dense_cycles: bool = False,
               block_rows: int = DEFAULT_BLOCK_ROWS, forward: bool = True,
               backward: bool = True) -> DataFrame:
    """Forward then backward fill of ``cols`` (pandas ``ffill().bfill()`` order)."""
    if scope not in ("unit", "table"):
        raise ValueError("scope must be 'unit' or 'table'")
    if dense_cycles:
        base, pos = df, F.col(cycle)
    else:
        base = with_position(df, unit, [cycle], value_bucket(cycle, block_rows), out="_pos")
        pos = F.col("_pos")
    b = base.withColumn("_blk", F.floor((pos - F.lit(1)) / F.lit(block_rows)))
    grp = Window.partitionBy(unit, "_blk").orderBy(pos)
    upto = grp.rowsBetween(Window.unboundedPreceding, 0)
    after = grp.rowsBetween(0, Window.unboundedFollowing)
    inner = {}
    for i, c in enumerate(cols):
        if forward:
            inner[f"_f{i}"] = F.last(c, ignorenulls=True).over(upto)
        if backward:
            inner[f"_b{i}"] = F.first(c, ignorenulls=True).over(after)
    b = b.withColumns(inner)

    # per-group summary: last / first non-null value, then carry across groups
    aggs = []
    for i, c in enumerate(cols):
        key = F.when(F.col(c).isNotNull(), pos)
        aggs += [F.max_by(c, key).alias(f"_l{i}"), F.min_by(c, key).alias(f"_s{i}")]
    summ = base.withColumn("_blk", F.floor((pos - F.lit(1)) / F.lit(block_rows))) \
        .groupBy(unit, "_blk").agg(*aggs)
    carry = []
    if scope == "unit":
        sw = Window.partitionBy(unit).orderBy("_blk")
        prev = sw.rowsBetween(Window.unboundedPreceding, -1)
        nxt = sw.rowsBetween(1, Window.unboundedFollowing)
        for i in range(len(cols)):
            if forward:
                carry.append(F.last(f"_l{i}", ignorenulls=True).over(prev).alias(f"_cf{i}"))
            if backward:
                carry.append(F.first(f"_s{i}", ignorenulls=True).over(nxt).alias(f"_cb{i}"))
    else:
        # table scope: one summary row per (unit, block), scanned in global order by a
        # range-partitioned two-pass scan (no single task holds the summary)
        sc = range_scan(summ, [unit, "_blk"], carries=[f"_l{i}" for i in range(len(cols))]
                        + [f"_s{i}" for i in range(len(cols))])
        summ = sc.withColumns({f"_cf{i}": F.col(f"_prev__l{i}") for i in range(len(cols))}
                              | {f"_cb{i}": F.col(f"_next__s{i}") for i in range(len(cols))})
        carry = [F.col(f"_cf{i}") for i in range(len(cols)) if forward] + \
            [F.col(f"_cb{i}") for i in range(len(cols)) if backward]
    summ = summ.select(F.col(unit).alias("_u"), F.col("_blk").alias("_bk"), *carry)
    j = b.join(summ, b[unit].eqNullSafe(summ["_u"]) & (b["_blk"] == summ["_bk"]), "left")
    out = {}
    for i, c in enumerate(cols):
        parts = []
        if forward:
            parts += [F.col(f"_f{i}"), F.col(f"_cf{i}")]
        if backward:
            parts += [F.col(f"_b{i}"), F.col(f"_cb{i}")]
        out[c] = F.coalesce(*parts)
    res = j.withColumns(out)
    return res.select(*df.columns)


def forward_fill(df: DataFrame, cols: list[str], **kw) -> DataFrame:
    return fill_nulls(df, cols, backward=False, **kw)


def backward_fill(df: DataFrame, cols: list[str], **kw) -> DataFrame:
    return fill_nulls(df, cols, forward=False, **kw)


def fill_remaining(df: DataFrame, cols: list[str] | None = None,
                   strategy: str = "constant") -> DataFrame:
    """Fill NULLs left after ffill/bfill (only all-null columns remain).

    ``constant``: numeric -> 0, string -> "unknown". ``mean`` / ``mode``: the
    column mean (numeric) or most frequent value (strings, and numbers for ``mode``; of equally
    frequent ones the least), falling back to the constants when a column has no value at all.
    """
    cols = cols or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in cols if isinstance(types[c], T.NumericType)]
    txt = [c for c in cols if isinstance(types[c], T.StringType)]
    fills = {c: NUMERIC_FILL for c in num}
    fills.update({c: STRING_FILL for c in txt})
    if strategy in ("mean", "mode") and (num or txt):
        if strategy == "mean" and num:
            means = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(num)]).first()
            fills.update({c: means[i] for i, c in enumerate(num) if means[i] is not None})
        fills.update(column_modes(df, txt if strategy == "mean" else num + txt))
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c]))
                           for c, v in fills.items()})


def repair(df: DataFrame, cols: list[str], scope: str = "unit", **kw) -> DataFrame:
    """ffill + bfill (scope) + remaining constants: the validation step's null handling."""
    return fill_remaining(fill_nulls(df, cols, scope=scope, **kw), cols)

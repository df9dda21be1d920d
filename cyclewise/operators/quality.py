"""Data-quality operators: column checks, type coercion, ranges, profiles, duplicates.

Whole-table statistics are computed in one aggregate each (map-side partial
aggregation, one tiny shuffle); only the resulting single row, bounded by the
number of columns, ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.schema import CYCLE, CYCLE_ALIASES, INTEGER_ID_NAMES, UNIT, UNIT_ALIASES


# ---------------------------------------------------------------- P1 columns
def check_columns(df: DataFrame, required: list[str] | dict | None) -> dict:
    """Required columns must be present. Identifier columns (and their aliases)
    found in the frame become required too; extra columns are reported and kept.

    ``required`` may be a list, a dict keyed by column, or a config with
    ``columns`` at the top level or nested under ``schema``.
    """
    spec = required
    if isinstance(spec, dict) and "columns" in spec:
        spec = spec["columns"]
    elif isinstance(spec, dict) and isinstance(spec.get("schema"), dict):
        spec = spec["schema"].get("columns")
    if spec is None:
        return {"ok": False, "missing": [], "extra": [], "error": "no columns in schema"}
    req = set(spec.keys() if isinstance(spec, dict) else spec)
    actual = set(df.columns)
    for c in [UNIT, CYCLE] + UNIT_ALIASES + CYCLE_ALIASES:
        if c in actual:
            req.add(c)
    missing, extra = sorted(req - actual), sorted(actual - req)
    return {"ok": not missing, "missing": missing, "extra": extra}


# ---------------------------------------------------------------- P2/P3 coerce
def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def to_double(col: str) -> Column:
    """Numeric coercion: unparsable -> NULL, NaN (text or value) -> NULL."""
    return nan_to_null(F.expr(f"try_cast(`{col}` AS DOUBLE)"))


def to_long(col: str) -> Column:
    """Integer coercion: unparsable or fractional -> NULL."""
    d = to_double(col)
    return F.when(d == F.floor(d), d.cast("long"))


def to_timestamp(col: str) -> Column:
    return F.expr(f"try_to_timestamp(CAST(`{col}` AS STRING))")


_DTYPE = {"datetime64[ns]": to_timestamp, "float64": to_double, "int64": to_long,
          "object": lambda c: F.col(c).cast("string")}


def coerce_types(df: DataFrame, spec: dict | list | None = None) -> DataFrame:
    """Coerce column types.

    dict form ``{col: {"dtype": ...}}`` (or ``{col: dtype}``): datetime64[ns] / float64 /
    int64 / object. list form (or None): ``sensor_*`` and ``op_setting_*`` to double,
    identifier names to long. Bad values become NULL; NULL stays NULL.
    """
    exprs = {}
    if isinstance(spec, dict):
        for c, s in spec.items():
            dt = s.get("dtype") if isinstance(s, dict) else s
            if c in df.columns and dt in _DTYPE:
                exprs[c] = _DTYPE[dt](c)
    else:
        for c in df.columns:
            if c.startswith("sensor_") or c.startswith("op_setting_"):
                exprs[c] = to_double(c)
            elif c in INTEGER_ID_NAMES:
                exprs[c] = to_long(c)
    return df.withColumns(exprs) if exprs else df


def coerce_report(df: DataFrame, spec: dict | list | None = None) -> DataFrame:
    """One row: per column, values that were non-null before coercion and NULL after."""
    cols = [c for c in df.columns if _coerced_expr(c, spec) is not None]
    return df.agg(*[F.count_if(F.col(c).isNotNull() & _coerced_expr(c, spec).isNull())
                    .cast("long").alias(c) for c in cols])


def _coerced_expr(c: str, spec) -> Column:
    if isinstance(spec, dict):
        s = spec.get(c)
        dt = s.get("dtype") if isinstance(s, dict) else s
        return _DTYPE[dt](c) if dt in _DTYPE else F.col(c)
    if c.startswith("sensor_") or c.startswith("op_setting_"):
        return to_double(c)
    if c in INTEGER_ID_NAMES:
        return to_long(c)
    return F.col(c)


# ---------------------------------------------------------------- P4 ranges
def clip_expr(c: str, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (bare greatest/least would skip it)."""
    x = F.col(c)
    return F.when(x.isNull(), x).otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def clip_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: clip_expr(c, lo, hi) for c, (lo, hi) in ranges.items()
                           if c in df.columns})


def count_out_of_range(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """One row, one long column per ranged column: values below min or above max."""
    return df.agg(*[F.count_if((F.col(c) < lo) | (F.col(c) > hi)).cast("long").alias(c)
                    for c, (lo, hi) in ranges.items() if c in df.columns])


# ---------------------------------------------------------------- P5/P6, S2
def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def _numeric_or_string(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.NumericType, T.StringType, T.DateType, T.TimestampType,
                                       T.TimestampNTZType, T.BooleanType))]


def constant_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: is it constant (exactly one distinct non-null value)?

    min = max over non-null values is exact and cheaper than countDistinct.
    Result: (column_name, is_constant), one row per column.
    """
    cols = cols or _numeric_or_string(df)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}")]
    row = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', coalesce(mn{i} = mx{i}, false)" for i, c in enumerate(cols))
    return row.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, is_constant)")


def constant_columns(df: DataFrame, cols: list[str] | None = None) -> list[str]:
    return [r.column_name for r in constant_report(df, cols).filter("is_constant").collect()]


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single non-null value (one aggregate job)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(df.columns)]) \
        .first()
    return df.drop(*[c for i, c in enumerate(df.columns) if counts[str(i)] == 0])


# ---------------------------------------------------------------- P11 profile
def profile_columns(df: DataFrame, id_col: str | None = UNIT) -> DataFrame:
    """(column_name, dtype, null_count, row_count, distinct_units) per column, one aggregate."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    has_id = id_col is not None and id_col in cols
    if has_id:
        aggs.append(F.countDistinct(id_col).alias("_units"))
    row = df.agg(*aggs)
    types = dict(df.dtypes)
    pairs = ", ".join(f"'{c}', '{types[c]}', CAST(n{i} AS BIGINT)" for i, c in enumerate(cols))
    units = "CAST(_units AS BIGINT)" if has_id else "CAST(NULL AS BIGINT)"
    return row.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, dtype, null_count)",
                          "CAST(_rows AS BIGINT) AS row_count", f"{units} AS distinct_units")


# ---------------------------------------------------------------- P12 duplicates
def duplicate_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: number of extra copies beyond the first (partial aggregation per key)."""
    cols = cols or df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicates"))


def drop_duplicates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(cols) if cols else df.dropDuplicates()


# ---------------------------------------------------------------- P13 z-score
def zscore_stats(df: DataFrame, col: str) -> tuple[float | None, float | None]:
    r = df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("s")).first()
    return r["m"], r["s"]


def zscore_outliers(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Rows with |x - mean| / sample std > k. The two statistics come from one
    aggregate (a single bounded row) and enter the filter as literals."""
    m, s = zscore_stats(df, col)
    if m is None or s is None or s == 0:
        return df.limit(0)
    return df.filter(F.abs(F.col(col) - F.lit(m)) / F.lit(s) > F.lit(k))


# ---------------------------------------------------------------- P14 slices
def slice_units(df: DataFrame, units: list | None = None, n: int | None = None,
                unit: str = UNIT) -> DataFrame:
    """Rows of the given units, or of the n smallest unit ids (semi join)."""
    if units is not None:
        return df.filter(F.col(unit).isin(list(units)))
    first = df.select(unit).distinct().orderBy(unit).limit(n)
    return df.join(F.broadcast(first), unit, "left_semi")

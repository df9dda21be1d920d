"""Experiment-run tables (O3-O5): search, compare, latest model version.

A run table is long: (run_id, key, value) with keys like ``metrics.rmse`` or
``params.max_depth`` (nested params flattened with "."). Non-finite metric
values are skipped when logging, as the tracker does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_params(d: dict, prefix: str = "") -> dict:
    """Nested dict -> {"a.b": v} (driver-side helper for logging a run's params)."""
    out = {}
    for k, v in d.items():
        key = f"{prefix}{k}"
        if isinstance(v, dict):
            out.update(flatten_params(v, key + "."))
        else:
            out[key] = v
    return out


def finite_metrics(long: DataFrame, value: str = "value") -> DataFrame:
    """Drop NaN / infinite metric values."""
    v = F.col(value)
    return long.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))


def compare_runs(long: DataFrame, keys: list[str] | None = None,
                 run_ids: list | None = None) -> DataFrame:
    """One wide row per run (with ``run_name`` where the table has one), a column per key.
    Values keep their type, text included. Without ``keys`` every key found gets a column
    (one small job lists them); given keys need no such job."""
    d = long if run_ids is None else long.filter(F.col("run_id").isin(list(run_ids)))
    runs = d.groupBy(*[c for c in ("run_id", "run_name") if c in long.columns])
    return (runs.pivot("key", keys) if keys else runs.pivot("key")).agg(F.max("value"))


def search_runs(long: DataFrame, keys: list[str], filter_expr: str | None = None,
                order_by: str = "`metrics.rmse`", ascending: bool = True,
                max_results: int = 100) -> DataFrame:
    """O3: filter on the wide run table, order (default rmse ascending), top ``max_results``."""
    wide = compare_runs(long, keys)
    if filter_expr:
        wide = wide.filter(filter_expr)
    o = F.expr(order_by)
    return wide.orderBy(o.asc_nulls_last() if ascending else o.desc_nulls_last(),
                        F.col("run_id")).limit(max_results)


DEFAULT_STAGES = ("Production", "Staging", "None")


def latest_versions(versions: DataFrame, stages=DEFAULT_STAGES) -> DataFrame:
    """Highest version per model name within the given stages; archived versions count
    only where their stage is given, or with ``stages`` None (all)."""
    v = versions if stages is None else versions.filter(F.col("stage").isin(list(stages)))
    return v.groupBy("name").agg(F.max("version").cast("long").alias("latest_version"))

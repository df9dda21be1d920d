"""Registered queries over the driver's tables, each with its DuckDB oracle SQL.

Every query reads whole tables (or panels Spark derives from them). Floating
outputs are rounded on both sides so that summation order cannot change the
value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.functions.risk import risk_level
from cyclewise.operators import features as feat
from cyclewise.schema import feature_base_columns
from cyclewise.sources.panels import (EVENTS_PANEL_SQL, LINEITEM_CHANNELS, LINEITEM_PANEL_SQL,
                                      MAX_CYCLE, RAW_FROM_EVENTS, events_panel, lineitem_panel,
                                      raw_panel)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

RND = 6  # decimals kept for floating outputs


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _r(c, d: int = RND):
    """round(c * 10^d) / 10^d: the same IEEE steps as the SQL twin ``_rs``."""
    return feat.rounded(c, d)


def _rs(expr: str, d: int = RND) -> str:
    m = float(10 ** d)
    return f"round(({expr}) * {m!r}) / {m!r}"


def _with(sql_body: str, **ctes: str) -> str:
    if not ctes:
        return sql_body
    head = ",\n".join(f"{k} AS ({v})" for k, v in ctes.items())
    return f"WITH {head}\n{sql_body}"


RISK_SQL = """CASE WHEN {p} < 20 THEN 'CRITICAL' WHEN {p} < 50 THEN 'HIGH'
     WHEN {p} < 100 THEN 'MEDIUM' ELSE 'LOW' END"""


# --- minimum slice: how many unit-cycles are in each risk band? -------------
@register("risk_band_counts", _with(f"""
SELECT risk_level, CAST(count(*) AS BIGINT) AS n
FROM (SELECT {RISK_SQL.format(p='RUL')} AS risk_level
      FROM (SELECT max(time_in_cycles) OVER (PARTITION BY unit_number) - time_in_cycles AS RUL
            FROM panel))
GROUP BY risk_level""", panel=EVENTS_PANEL_SQL))
def q_risk_band_counts(spark, sf):
    p = feat.add_rul(events_panel(spark, sf, with_max=True), max_col=MAX_CYCLE)
    return p.groupBy(risk_level("RUL").alias("risk_level")).agg(F.count(F.lit(1)).alias("n"))



# --- W1-W4, P7: label + lag + rolling features ------------------------------
def features_sql(panel_sql: str, cols: list[str], ids: list[str], lags=feat.LAGS,
                 windows=feat.WINDOWS, rul: bool = True, dropna: bool = True, d: int = 4) -> str:
    """DuckDB twin of ``window_features`` (+ RUL, + drop of incomplete rows)."""
    part = "PARTITION BY unit_number ORDER BY time_in_cycles"
    sel = list(ids) + list(cols)
    if rul:
        sel.append("CAST(max(time_in_cycles) OVER (PARTITION BY unit_number) - time_in_cycles "
                   "AS BIGINT) AS RUL")
    names = []
    for c in cols:
        for k in lags:
            n = feat.lag_name(c, k)
            sel.append(f"lag({c}, {k}) OVER ({part}) AS {n}")
            names.append(n)
    for c in cols:
        for n in windows:
            m, s = feat.rolling_names(c, n)
            fr = f"{part} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"
            sel.append(f"avg({c}) OVER ({fr}) AS {m}")
            sel.append(f"stddev_samp({c}) OVER ({fr}) AS {s}")
            names += [m, s]
    inner = f"SELECT {', '.join(sel)} FROM panel"
    outer = list(ids) + list(cols) + (["RUL"] if rul else []) + \
        [f"{_rs(n, d)} AS {n}" for n in names]
    where = ""
    if dropna:
        every = list(ids) + list(cols) + (["RUL"] if rul else []) + names
        where = " WHERE " + " AND ".join(f"{n} IS NOT NULL" for n in every)
    return _with(f"SELECT {', '.join(outer)} FROM ({inner}) f{where}", panel=panel_sql)


def _round_features(df: DataFrame, cols: list[str], lags=feat.LAGS, windows=feat.WINDOWS,
                    d: int = 4) -> DataFrame:
    names = set(feat.feature_names(cols, lags, windows))
    return df.select(*[_r(c, d).alias(c) if c in names else F.col(c) for c in df.columns])


LI_IDS = ["unit_number", "time_in_cycles"]
EV_IDS = ["unit_number", "time_in_cycles", "event_id"]
EV_COLS = ["value", "k"]


@register("features_lineitem", features_sql(LINEITEM_PANEL_SQL, LINEITEM_CHANNELS, LI_IDS))
def q_features_lineitem(spark, sf):
    p = lineitem_panel(spark, sf, with_max=True)
    return feat.build_feature_table(p, LINEITEM_CHANNELS, dense_cycles=True, max_col=MAX_CYCLE, decimals=4)


@register("features_events", features_sql(EVENTS_PANEL_SQL, EV_COLS, EV_IDS))
def q_features_events(spark, sf):
    p = events_panel(spark, sf, with_max=True).drop("ts")
    return feat.build_feature_table(p, EV_COLS, dense_cycles=True, max_col=MAX_CYCLE, decimals=4)


@register("lags_events", features_sql(EVENTS_PANEL_SQL, EV_COLS, EV_IDS, windows=[], rul=False,
                                      dropna=False))
def q_lags_events(spark, sf):
    # positions re-derived from the cycle column: exercises the non-dense path
    p = events_panel(spark, sf).drop("ts")
    return feat.add_lags(p, EV_COLS, dense_cycles=False)


@register("rolling_lineitem", features_sql(LINEITEM_PANEL_SQL, LINEITEM_CHANNELS, LI_IDS, lags=[],
                                           rul=False, dropna=False))
def q_rolling_lineitem(spark, sf):
    p = lineitem_panel(spark, sf)
    return feat.add_rolling(p, LINEITEM_CHANNELS, dense_cycles=True, decimals=4)


@register("rul_by_join", _with("""
SELECT p.unit_number, p.time_in_cycles, CAST(m.mx - p.time_in_cycles AS BIGINT) AS RUL
FROM panel p LEFT JOIN (SELECT unit_number, max(time_in_cycles) AS mx FROM panel GROUP BY 1) m
  ON p.unit_number = m.unit_number""", panel=LINEITEM_PANEL_SQL))
def q_rul_by_join(spark, sf):
    return feat.add_rul(lineitem_panel(spark, sf), method="join") \
        .select("unit_number", "time_in_cycles", "RUL")


@register("rul_by_window", _with("""
SELECT unit_number, time_in_cycles,
       CAST(max(time_in_cycles) OVER (PARTITION BY unit_number) - time_in_cycles AS BIGINT) AS RUL
FROM panel""", panel=EVENTS_PANEL_SQL))
def q_rul_by_window(spark, sf):
    return feat.add_rul(events_panel(spark, sf), method="window") \
        .select("unit_number", "time_in_cycles", "RUL")
FLAGSHIP = "features_lineitem"


# --- W5-W7: null repair ------------------------------------------------------
from cyclewise.operators import fill as fill_ops  # noqa: E402
from cyclewise.operators import quality as qual  # noqa: E402

# Nulls made by a rule on the data itself, so SQL can repeat it.
LI_NULLS_SQL = """SELECT unit_number, time_in_cycles,
  CASE WHEN l_discount < 0.03 THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN l_tax > 0.05 THEN NULL ELSE l_extendedprice END AS l_extendedprice
FROM panel0"""
EV_NULLS_SQL = """SELECT unit_number, time_in_cycles, event_id,
  CASE WHEN value < 20 THEN NULL ELSE value END AS value,
  CASE WHEN k > 80 THEN NULL ELSE k END AS k
FROM panel0"""


def _li_nulls(spark, sf):
    p = lineitem_panel(spark, sf)
    return p.select("unit_number", "time_in_cycles",
                    F.when(F.col("l_discount") < 0.03, None).otherwise(F.col("l_quantity"))
                    .alias("l_quantity"),
                    F.when(F.col("l_tax") > 0.05, None).otherwise(F.col("l_extendedprice"))
                    .alias("l_extendedprice"))


def _ev_nulls(spark, sf):
    p = events_panel(spark, sf)
    return p.select("unit_number", "time_in_cycles", "event_id",
                    F.when(F.col("value") < 20, None).otherwise(F.col("value")).alias("value"),
                    F.when(F.col("k") > 80, None).otherwise(F.col("k")).alias("k"))


def _fill_sql(ids, cols, part):
    sel = list(ids)
    for c in cols:
        sel.append(f"coalesce(last_value({c} IGNORE NULLS) OVER ({part} ROWS BETWEEN UNBOUNDED "
                   f"PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER ({part} ROWS "
                   f"BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}")
    return "SELECT " + ", ".join(sel) + " FROM panel"


@register("fill_unit_lineitem", _with(
    _fill_sql(LI_IDS, ["l_quantity", "l_extendedprice"],
              "PARTITION BY unit_number ORDER BY time_in_cycles"),
    panel0=LINEITEM_PANEL_SQL, panel=LI_NULLS_SQL))
def q_fill_unit_lineitem(spark, sf):
    return fill_ops.fill_nulls(_li_nulls(spark, sf), ["l_quantity", "l_extendedprice"],
                               scope="unit", dense_cycles=True)


@register("fill_table_events", _with(
    _fill_sql(EV_IDS, ["value", "k"], "ORDER BY unit_number, time_in_cycles"),
    panel0=EVENTS_PANEL_SQL, panel=EV_NULLS_SQL))
def q_fill_table_events(spark, sf):
    return fill_ops.fill_nulls(_ev_nulls(spark, sf), ["value", "k"], scope="table",
                               dense_cycles=True)


@register("fill_unit_blocks_events", _with(
    _fill_sql(EV_IDS, ["value", "k"], "PARTITION BY unit_number ORDER BY time_in_cycles"),
    panel0=EVENTS_PANEL_SQL, panel=EV_NULLS_SQL))
def q_fill_unit_blocks_events(spark, sf):
    # positions re-derived and 16-row blocks: exercises the cross-block carry
    return fill_ops.fill_nulls(_ev_nulls(spark, sf), ["value", "k"], scope="unit",
                               dense_cycles=False, block_rows=16)


@register("fill_remaining_lineitem", _with("""
SELECT unit_number, time_in_cycles, coalesce(l_quantity, 0) AS l_quantity,
       coalesce(l_extendedprice, 0) AS l_extendedprice,
       coalesce(CAST(NULL AS DOUBLE), 0) AS all_null
FROM panel""", panel0=LINEITEM_PANEL_SQL, panel=LI_NULLS_SQL))
def q_fill_remaining_lineitem(spark, sf):
    df = _li_nulls(spark, sf).withColumn("all_null", F.lit(None).cast("double"))
    return fill_ops.fill_remaining(df, ["l_quantity", "l_extendedprice", "all_null"])


# --- P2-P6, P11-P14, S2: data quality -----------------------------------------
LI_RANGES = {"l_quantity": (5.0, 45.0), "l_discount": (0.01, 0.09), "l_tax": (0.0, 0.06)}


@register("clip_ranges_lineitem", _with("""
SELECT unit_number, time_in_cycles,
  CASE WHEN l_quantity IS NULL THEN NULL ELSE greatest(5.0, least(45.0, l_quantity)) END AS l_quantity,
  l_extendedprice,
  CASE WHEN l_discount IS NULL THEN NULL ELSE greatest(0.01, least(0.09, l_discount)) END AS l_discount,
  CASE WHEN l_tax IS NULL THEN NULL ELSE greatest(0.0, least(0.06, l_tax)) END AS l_tax
FROM panel""", panel=LINEITEM_PANEL_SQL))
def q_clip_ranges_lineitem(spark, sf):
    return qual.clip_ranges(lineitem_panel(spark, sf), LI_RANGES)


@register("out_of_range_lineitem", """
SELECT CAST(count(*) FILTER (WHERE l_quantity < 5.0 OR l_quantity > 45.0) AS BIGINT) AS l_quantity,
       CAST(count(*) FILTER (WHERE l_discount < 0.01 OR l_discount > 0.09) AS BIGINT) AS l_discount,
       CAST(count(*) FILTER (WHERE l_tax < 0.0 OR l_tax > 0.06) AS BIGINT) AS l_tax
FROM lineitem""")
def q_out_of_range_lineitem(spark, sf):
    from cyclewise.sources.panels import table
    return qual.count_out_of_range(table(spark, sf, "lineitem"), LI_RANGES)


ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]


def _orders(spark, sf):
    from cyclewise.sources.panels import table
    o = table(spark, sf, "orders")
    return o.select(*[c for c in ORDERS_COLS if c in o.columns])


@register("constant_columns_lineitem_flags", """
SELECT column_name, is_constant FROM (
  SELECT 'l_returnflag' AS column_name, coalesce(min(l_returnflag) = max(l_returnflag), false) AS is_constant FROM lineitem
  UNION ALL SELECT 'l_linestatus', coalesce(min(l_linestatus) = max(l_linestatus), false) FROM lineitem
  UNION ALL SELECT 'l_linenumber', coalesce(min(l_linenumber) = max(l_linenumber), false) FROM lineitem
  UNION ALL SELECT 'l_tax', coalesce(min(l_tax) = max(l_tax), false) FROM lineitem)""")
def q_constant_columns(spark, sf):
    from cyclewise.sources.panels import table
    return qual.constant_report(table(spark, sf, "lineitem"),
                                ["l_returnflag", "l_linestatus", "l_linenumber", "l_tax"])


@register("profile_events", """
SELECT column_name, dtype, null_count, row_count, distinct_units FROM (
  SELECT 'event_id' AS column_name, 'bigint' AS dtype, CAST(count(*) FILTER (WHERE event_id IS NULL) AS BIGINT) AS null_count FROM events
  UNION ALL SELECT 'ts', 'timestamp_ntz', CAST(count(*) FILTER (WHERE ts IS NULL) AS BIGINT) FROM events
  UNION ALL SELECT 'user_id', 'bigint', CAST(count(*) FILTER (WHERE user_id IS NULL) AS BIGINT) FROM events
  UNION ALL SELECT 'event_type', 'string', CAST(count(*) FILTER (WHERE event_type IS NULL) AS BIGINT) FROM events
  UNION ALL SELECT 'value', 'double', CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) FROM events
  UNION ALL SELECT 'props', 'string', CAST(count(*) FILTER (WHERE props IS NULL) AS BIGINT) FROM events) c,
  (SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT user_id) AS BIGINT) AS distinct_units FROM events) t""")
def q_profile_events(spark, sf):
    from cyclewise.sources.panels import table
    return qual.profile_columns(table(spark, sf, "events"), id_col="user_id")


@register("profile_lineitem", _with("""
SELECT column_name, dtype, null_count, row_count, distinct_units FROM (
  SELECT 'unit_number' AS column_name, 'bigint' AS dtype, CAST(count(*) FILTER (WHERE unit_number IS NULL) AS BIGINT) AS null_count FROM panel
  UNION ALL SELECT 'time_in_cycles', 'bigint', CAST(count(*) FILTER (WHERE time_in_cycles IS NULL) AS BIGINT) FROM panel
  UNION ALL SELECT 'l_quantity', 'double', CAST(count(*) FILTER (WHERE l_quantity IS NULL) AS BIGINT) FROM panel
  UNION ALL SELECT 'l_extendedprice', 'double', CAST(count(*) FILTER (WHERE l_extendedprice IS NULL) AS BIGINT) FROM panel) c,
  (SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(count(DISTINCT unit_number) AS BIGINT) AS distinct_units FROM panel) t""",
    panel0=LINEITEM_PANEL_SQL, panel=LI_NULLS_SQL))
def q_profile_lineitem(spark, sf):
    return qual.profile_columns(_li_nulls(spark, sf))


@register("duplicates_lineitem_key", """
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def q_duplicates_lineitem_key(spark, sf):
    from cyclewise.sources.panels import table
    return qual.duplicate_count(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("union_duplicates_events", """
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS c FROM (SELECT * FROM events UNION ALL
      SELECT * FROM events WHERE event_type = 'purchase')
      GROUP BY event_id, ts, user_id, event_type, value, props)""")
def q_union_duplicates_events(spark, sf):
    # O6 union + P12: the table plus a copy of its purchase rows
    from cyclewise.operators.ranking import union_panels
    from cyclewise.sources.panels import table
    ev = table(spark, sf, "events")
    return qual.duplicate_count(union_panels(ev, ev.filter(F.col("event_type") == "purchase")))


@register("drop_duplicates_events", """
SELECT DISTINCT user_id, event_type FROM events""")
def q_drop_duplicates_events(spark, sf):
    from cyclewise.sources.panels import table
    return qual.drop_duplicates(table(spark, sf, "events").select("user_id", "event_type"))


@register("zscore_outliers_events", """
SELECT event_id, user_id, value FROM events,
  (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events) st
WHERE abs(value - m) / s > 3""")
def q_zscore_outliers_events(spark, sf):
    from cyclewise.sources.panels import table
    ev = table(spark, sf, "events").select("event_id", "user_id", "value")
    return qual.zscore_outliers(ev, "value", k=3.0)


@register("slice_first_units_events", _with("""
SELECT * FROM panel WHERE unit_number IN
  (SELECT DISTINCT unit_number FROM panel ORDER BY unit_number LIMIT 5)""",
    panel=EVENTS_PANEL_SQL.replace("event_id, ts, value", "event_id, value")))
def q_slice_first_units_events(spark, sf):
    return qual.slice_units(events_panel(spark, sf).drop("ts"), n=5)


@register("coerce_events_text", """
SELECT event_id,
  CASE WHEN isnan(TRY_CAST(event_type AS DOUBLE)) THEN NULL ELSE TRY_CAST(event_type AS DOUBLE) END AS sensor_1,
  CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) = floor(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE))
       THEN CAST(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS BIGINT) END AS unit_number,
  CASE WHEN isnan(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE)) THEN NULL ELSE TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) END AS op_setting_1
FROM events""")
def q_coerce_events_text(spark, sf):
    # list-form coercion on text columns: event names are not numbers -> NULL
    from cyclewise.sources.panels import table
    ev = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("sensor_1"),
        F.get_json_object("props", "$.k").alias("unit_number"),
        F.col("value").cast("string").alias("op_setting_1"))
    return qual.coerce_types(ev)


@register("drop_all_null_columns_events", """
SELECT event_id, value FROM events""")
def q_drop_all_null_columns_events(spark, sf):
    from cyclewise.sources.panels import table
    ev = table(spark, sf, "events").select("event_id", "value",
                                           F.lit(None).cast("double").alias("empty"))
    return qual.drop_all_null_columns(ev)


# --- A1-A10, P15, P16, J3, O1, O2: metrics and reports -------------------------
from cyclewise.operators import aggregates as agg  # noqa: E402
from cyclewise.operators import ranking  # noqa: E402
from cyclewise.operators.forecast import NAIVE_MODELS, naive_forecasts  # noqa: E402

D4 = 4


def _round_all(df: DataFrame, d: int = D4) -> DataFrame:
    dbl = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[_r(c, d).alias(c) if c in dbl else F.col(c) for c in df.columns])


def _round_sql(select_body: str, cols: list[str], keep: list[str] = (), d: int = D4) -> str:
    outs = list(keep) + [f"{_rs(c, d)} AS {c}" for c in cols]
    return f"SELECT {', '.join(outs)} FROM ({select_body}) r"


MODELS = list(NAIVE_MODELS)
METRIC_COLS = ["mse", "rmse", "mae", "r2", "mape", "smape", "max_error", "min_error", "std_error"]


def _forecast_sql(src="panel", y="value"):
    part = "PARTITION BY unit_number ORDER BY time_in_cycles"
    sel = [f"avg({y}) OVER ({part} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS {m}_rul"
           for m, n in NAIVE_MODELS.items()]
    return f"SELECT unit_number, time_in_cycles, {y}, {', '.join(sel)} FROM {src}"


def _metrics_sql(y: str, p: str, src: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    body = f"""SELECT {g}avg(e*e) AS mse, sqrt(avg(e*e)) AS rmse, avg(abs(e)) AS mae,
  CASE WHEN var_pop({y})*count(*) = 0 THEN (CASE WHEN sum(e*e) = 0 THEN 1.0 ELSE 0.0 END)
       ELSE 1 - sum(e*e)/(var_pop({y})*count(*)) END AS r2,
  CASE WHEN count(*) FILTER (WHERE {y} <> 0) > 0
       THEN avg(CASE WHEN {y} <> 0 THEN abs(e)/abs({y}) END)*100 ELSE 'inf'::DOUBLE END AS mape,
  100*avg(2*abs(e)/(abs({y})+abs({p})+1e-8)) AS smape,
  max(abs(e)) AS max_error, min(abs(e)) AS min_error, stddev_pop(e) AS std_error
FROM (SELECT *, {y} - {p} AS e FROM {src} WHERE {y} IS NOT NULL AND {p} IS NOT NULL) x
{('GROUP BY ' + group) if group else ''}"""
    return _round_sql(body, METRIC_COLS, keep=[group] if group else [])


def _ev_forecasts(spark, sf):
    p = events_panel(spark, sf).select("unit_number", "time_in_cycles", "value")
    return naive_forecasts(p, "value", dense_cycles=True)


@register("regression_metrics", _with(_metrics_sql("value", "mean5_rul", "fc"),
                                      panel=EVENTS_PANEL_SQL, fc=_forecast_sql()))
def q_regression_metrics(spark, sf):
    return _round_all(agg.regression_metrics(_ev_forecasts(spark, sf), "value", "mean5_rul"))


@register("training_metrics_lineitem", _with(
    "SELECT mse, rmse, mae, r2 FROM (" + _metrics_sql("l_quantity", "last_rul", "fc") + ") m",
    panel=LINEITEM_PANEL_SQL, fc=_forecast_sql(y="l_quantity")))
def q_training_metrics_lineitem(spark, sf):
    p = lineitem_panel(spark, sf).select("unit_number", "time_in_cycles", "l_quantity")
    fc = naive_forecasts(p, "l_quantity", dense_cycles=True)
    return _round_all(agg.training_metrics(fc, "l_quantity", "last_rul"))


_ENS_SQL = ("CASE WHEN " + " + ".join(f"CAST({m}_rul IS NOT NULL AS INT)" for m in MODELS) +
            " > 0 THEN (" + " + ".join(f"coalesce({m}_rul, 0)" for m in MODELS) + ") / (" +
            " + ".join(f"CAST({m}_rul IS NOT NULL AS INT)" for m in MODELS) + ") END")


@register("compare_models_events", _with(_round_sql(
    f"SELECT *, {_ENS_SQL} AS ensemble_rul FROM fc",
    [f"{m}_rul" for m in MODELS] + ["ensemble_rul"], keep=["unit_number", "time_in_cycles", "value"]),
    panel=EVENTS_PANEL_SQL, fc=_forecast_sql()))
def q_compare_models_events(spark, sf):
    return _round_all(agg.ensemble_mean(_ev_forecasts(spark, sf)))


_LONG_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS model, CAST({i + 1} AS BIGINT) AS model_order, value, {m}_rul AS p FROM fc"
    for i, m in enumerate(MODELS))
_BY_MODEL_SQL = _metrics_sql("value", "p", "lp", group="model, model_order")


@register("metrics_by_model", _with(_BY_MODEL_SQL, panel=EVENTS_PANEL_SQL, fc=_forecast_sql(),
                                    lp=_LONG_SQL))
def q_metrics_by_model(spark, sf):
    return _round_all(agg.metrics_by_model(_ev_forecasts(spark, sf), "value", MODELS))


@register("evaluation_summary", _with(_round_sql(
    "SELECT CAST(count(*) AS BIGINT) AS total_models_evaluated, avg(rmse) AS avg_rmse, "
    "avg(r2) AS avg_r2, min(rmse) AS best_rmse, max(r2) AS best_r2 FROM bm",
    ["avg_rmse", "avg_r2", "best_rmse", "best_r2"], keep=["total_models_evaluated"]),
    panel=EVENTS_PANEL_SQL, fc=_forecast_sql(), lp=_LONG_SQL, bm=_BY_MODEL_SQL))
def q_evaluation_summary(spark, sf):
    m = agg.metrics_by_model(_ev_forecasts(spark, sf), "value", MODELS)
    return _round_all(agg.evaluation_summary(m))


@register("best_model", _with("""
SELECT model AS name, rmse, r2,
  CASE WHEN r2 > 0.9 THEN 'Excellent performance! ' || model || ' achieves R2 > 0.9'
       WHEN r2 > 0.7 THEN 'Good performance. Consider feature engineering to improve ' || model
       ELSE 'Consider additional feature engineering or trying ensemble methods' END AS recommendation
FROM bm ORDER BY rmse, model_order LIMIT 1""",
    panel=EVENTS_PANEL_SQL, fc=_forecast_sql(), lp=_LONG_SQL, bm=_BY_MODEL_SQL))
def q_best_model(spark, sf):
    m = _round_all(agg.metrics_by_model(_ev_forecasts(spark, sf), "value", MODELS))
    return agg.best_model(m)


@register("leaderboard", _with("""
SELECT *, CAST(row_number() OVER (ORDER BY r2 DESC, model) AS BIGINT) AS rank FROM bm""",
    panel=EVENTS_PANEL_SQL, fc=_forecast_sql(), lp=_LONG_SQL, bm=_BY_MODEL_SQL))
def q_leaderboard(spark, sf):
    m = _round_all(agg.metrics_by_model(_ev_forecasts(spark, sf), "value", MODELS))
    return ranking.leaderboard(m, "r2")


@register("prediction_stats", _with(_round_sql("""
SELECT CAST(count(*) AS BIGINT) AS total_records, avg(p) AS mean_rul, min(p) AS min_rul,
  max(p) AS max_rul, stddev_pop(p) AS std_rul,
  CAST(count(*) FILTER (WHERE p < 20) AS BIGINT) AS critical_count,
  CAST(count(*) FILTER (WHERE p >= 20 AND p < 50) AS BIGINT) AS high_risk_count,
  CAST(count(*) FILTER (WHERE p >= 50 AND p < 100) AS BIGINT) AS medium_risk_count,
  CAST(count(*) FILTER (WHERE p >= 100) AS BIGINT) AS low_risk_count
FROM (SELECT mean5_rul AS p FROM fc WHERE mean5_rul IS NOT NULL)""",
    ["mean_rul", "min_rul", "max_rul", "std_rul"],
    keep=["total_records", "critical_count", "high_risk_count", "medium_risk_count",
          "low_risk_count"]), panel=EVENTS_PANEL_SQL, fc=_forecast_sql()))
def q_prediction_stats(spark, sf):
    fc = _ev_forecasts(spark, sf).filter(F.col("mean5_rul").isNotNull())
    return _round_all(agg.prediction_stats(fc, "mean5_rul"))


def _hist_sql(src: str, col: str, bins: int = 50) -> str:
    return f"""SELECT CAST(b.i AS BIGINT) AS bin, {_rs(f'lo + b.i * w', 6)} AS bin_start,
  {_rs(f'lo + (b.i + 1) * w', 6)} AS bin_end, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (SELECT min({col}) AS lo, max({col}) AS hi,
             CASE WHEN max({col}) > min({col}) THEN (max({col}) - min({col})) / {bins}.0 ELSE 1.0 END AS w
      FROM {src}) s
CROSS JOIN range({bins}) b(i)
LEFT JOIN (SELECT least({bins - 1}, CAST(floor((x - lo) / w) AS BIGINT)) AS bin,
                  count(*) AS n
           FROM (SELECT {col} AS x FROM {src} WHERE {col} IS NOT NULL),
                (SELECT min({col}) AS lo, max({col}) AS hi,
                        CASE WHEN max({col}) > min({col}) THEN (max({col}) - min({col})) / {bins}.0 ELSE 1.0 END AS w
                 FROM {src}) s2
           GROUP BY 1) c ON c.bin = b.i"""


def _round_hist(df):
    return df.select("bin", _r("bin_start", 6).alias("bin_start"), _r("bin_end", 6).alias("bin_end"),
                     "count")


@register("histogram_rul", _with(_hist_sql("rp", "CAST(RUL AS DOUBLE)"), panel=LINEITEM_PANEL_SQL,
                                 rp="SELECT max(time_in_cycles) OVER (PARTITION BY unit_number) "
                                    "- time_in_cycles AS RUL FROM panel"))
def q_histogram_rul(spark, sf):
    p = feat.add_rul(lineitem_panel(spark, sf, with_max=True), max_col=MAX_CYCLE)
    return _round_hist(agg.histogram(p.select(F.col("RUL").cast("double").alias("RUL")), "RUL"))


@register("residual_histogram", _with(_hist_sql("res", "residual", 20), panel=EVENTS_PANEL_SQL,
                                      fc=_forecast_sql(),
                                      res="SELECT value - mean5_rul AS residual FROM fc"))
def q_residual_histogram(spark, sf):
    r = agg.residuals(_ev_forecasts(spark, sf), "value", "mean5_rul")
    return _round_hist(agg.histogram(r.select("residual"), "residual", 20))


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("correlation_lineitem", "SELECT col_a, col_b, " + _rs("corr", D4) + " AS corr FROM (" +
          " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr "
                             f"FROM lineitem" for a in _CORR_COLS for b in _CORR_COLS) + ")")
def q_correlation_lineitem(spark, sf):
    from cyclewise.sources.panels import table
    return _round_all(agg.correlation_matrix(table(spark, sf, "lineitem"), _CORR_COLS))


@register("dataset_overview", _with("""
SELECT CAST(count(*) AS BIGINT) AS samples, CAST(4 AS BIGINT) AS features,
       CAST(count(DISTINCT unit_number) AS BIGINT) AS units FROM panel""", panel=LINEITEM_PANEL_SQL))
def q_dataset_overview(spark, sf):
    return agg.dataset_overview(lineitem_panel(spark, sf))


@register("truth_total", _with("""
SELECT CAST(sum(mx) AS BIGINT) AS total_rul
FROM (SELECT max(time_in_cycles) AS mx FROM panel GROUP BY unit_number)""", panel=EVENTS_PANEL_SQL))
def q_truth_total(spark, sf):
    # truth table: one value per unit, its life length (RUL one cycle before the first)
    p = feat.add_rul(events_panel(spark, sf, with_max=True), max_col=MAX_CYCLE)
    per_unit = p.groupBy("unit_number").agg((F.max("RUL") + 1).alias("RUL"))
    return agg.truth_total(per_unit)


@register("prediction_trace", _with(_round_sql(
    "SELECT unit_number, time_in_cycles, value, mean5_rul FROM fc "
    "ORDER BY unit_number, time_in_cycles LIMIT 200", ["mean5_rul"],
    keep=["unit_number", "time_in_cycles", "value"]), panel=EVENTS_PANEL_SQL, fc=_forecast_sql()))
def q_prediction_trace(spark, sf):
    fc = _ev_forecasts(spark, sf).select("unit_number", "time_in_cycles", "value", "mean5_rul")
    return _round_all(ranking.prediction_trace(fc, 200))


# --- O7, O8, M1, M2: splits and scaling ------------------------------------------
from cyclewise.operators import scale as scl  # noqa: E402
from cyclewise.operators import split as spl  # noqa: E402

_LI_KEY = ["unit_number", "time_in_cycles"]
_H = spl.split_hash_sql(_LI_KEY)


@register("split_hash_lineitem", _with(f"""
SELECT unit_number, time_in_cycles, CASE WHEN {_H} < 858993459 THEN 'test' ELSE 'train' END AS split
FROM panel""", panel=LINEITEM_PANEL_SQL))
def q_split_hash_lineitem(spark, sf):
    return spl.hash_split(lineitem_panel(spark, sf).select(*_LI_KEY), _LI_KEY)


@register("split_hash_exact_events", _with(f"""
SELECT event_id, CASE WHEN row_number() OVER (ORDER BY {spl.split_hash_sql(['event_id'])}, event_id)
                      <= ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS split
FROM events"""))
def q_split_hash_exact_events(spark, sf):
    from cyclewise.sources.panels import table
    ev = table(spark, sf, "events").select("event_id")
    return spl.hash_split(ev, ["event_id"], exact=True)


@register("split_tail_table_lineitem", _with("""
SELECT unit_number, time_in_cycles,
  CASE WHEN row_number() OVER (ORDER BY unit_number, time_in_cycles) <= floor(count(*) OVER () * 0.8)
       THEN 'train' ELSE 'test' END AS split
FROM panel""", panel=LINEITEM_PANEL_SQL))
def q_split_tail_table_lineitem(spark, sf):
    return spl.tail_split(lineitem_panel(spark, sf).select(*_LI_KEY), 0.2, scope="table")


@register("split_tail_unit_events", _with("""
SELECT unit_number, time_in_cycles,
  CASE WHEN time_in_cycles <= floor(count(*) OVER (PARTITION BY unit_number) * 0.8)
       THEN 'train' ELSE 'test' END AS split
FROM panel""", panel=EVENTS_PANEL_SQL))
def q_split_tail_unit_events(spark, sf):
    return spl.tail_split(events_panel(spark, sf).select(*_LI_KEY), 0.2, scope="unit")


def _scale_sql(kind: str) -> str:
    cols = LINEITEM_CHANNELS
    if kind == "standard":
        st = ", ".join(f"avg({c}) AS a_{c}, CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0 "
                       f"ELSE stddev_pop({c}) END AS b_{c}" for c in cols)
    else:
        st = ", ".join(f"min({c}) AS a_{c}, CASE WHEN max({c}) = min({c}) OR max({c}) IS NULL "
                       f"THEN 1.0 ELSE max({c}) - min({c}) END AS b_{c}" for c in cols)
    body = (f"SELECT p.unit_number, p.time_in_cycles, p.split, " +
            ", ".join(f"(p.{c} - s.a_{c}) / s.b_{c} AS {c}" for c in cols) +
            f" FROM sp p, (SELECT {st} FROM sp WHERE split = 'train') s")
    return _with(_round_sql(body, cols, keep=["unit_number", "time_in_cycles", "split"], d=6),
                 panel=LINEITEM_PANEL_SQL,
                 sp=f"SELECT *, CASE WHEN {_H} < 858993459 THEN 'test' ELSE 'train' END AS split "
                    f"FROM panel")


def _scaled(spark, sf, fn):
    p = spl.hash_split(lineitem_panel(spark, sf), _LI_KEY)
    s = fn(p, LINEITEM_CHANNELS, fit=p.filter(F.col("split") == "train"))
    return s.select("unit_number", "time_in_cycles", "split",
                    *[_r(c, 6).alias(c) for c in LINEITEM_CHANNELS])


@register("standard_scale_lineitem", _scale_sql("standard"))
def q_standard_scale_lineitem(spark, sf):
    return _scaled(spark, sf, scl.standard_scale)


@register("minmax_scale_lineitem", _scale_sql("minmax"))
def q_minmax_scale_lineitem(spark, sf):
    return _scaled(spark, sf, scl.minmax_scale)


# --- M3-M12: models (no SQL twin: the driver's rows-only check + our tests) ----
def _event_training(spark, sf):
    from cyclewise.plans.training import feature_table, split_table
    p = events_panel(spark, sf, with_max=True).drop("ts", "event_id")
    ft, fcols = feature_table(p, EV_COLS, dense_cycles=True, max_col=MAX_CYCLE)
    train, test = split_table(ft)
    return train, test, fcols


def _metrics_out(metrics, cols=("rmse", "mae", "r2")):
    return _round_all(metrics.select("model", *cols))


@register("train_score_events")
def q_train_score_events(spark, sf):
    """Linear, ridge, lasso and random forest on the events feature table; test metrics."""
    from cyclewise.ml import models as mdl
    train, test, fcols = _event_training(spark, sf)
    models = mdl.train_all(train, fcols, ["linear_regression", "ridge", "lasso", "random_forest"])
    return _metrics_out(mdl.evaluate_all(models, test))


@register("train_boosting_svr_events")
def q_train_boosting_svr_events(spark, sf):
    from cyclewise.ml import models as mdl
    train, test, fcols = _event_training(spark, sf)
    models = mdl.train_all(train, fcols, ["gradient_boosting", "svr"])
    return _metrics_out(mdl.evaluate_all(models, test))


@register("batch_score_events")
def q_batch_score_events(spark, sf):
    """Fit ridge on the training split, then score the raw panel, every row of it,
    through one serving PipelineModel (features + scaler + regressor)."""
    from cyclewise.ml import models as mdl
    from cyclewise.plans.scoring import score
    from cyclewise.plans.training import serving_model
    train, _, fcols = _event_training(spark, sf)
    fitted = mdl.train_all(train, fcols, ["ridge"])["ridge"]
    serving = serving_model(fitted, EV_COLS, dense_cycles=True)
    raw = events_panel(spark, sf).drop("ts", "event_id")
    return score(serving, raw, "ridge", run_ts="run")



# A given linear rule as the model: scoring, its written rows and their stats have SQL twins.
_RULE = "0.5 * value + 0.25 * value_lag_1 + k"
_RULE_SQL = f"""SELECT unit_number, time_in_cycles, CASE WHEN time_in_cycles > {max(feat.LAGS)} THEN
  0.5 * value + 0.25 * lag(value, 1) OVER (PARTITION BY unit_number ORDER BY time_in_cycles) + k
  END AS p FROM panel"""


def _rule_scores(spark, sf):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer, VectorAssembler
    from cyclewise.ml.stages import PanelFeatures
    from cyclewise.plans.scoring import score
    inputs = EV_COLS + feat.feature_names(EV_COLS, feat.LAGS, feat.WINDOWS)
    model = PipelineModel(stages=[
        PanelFeatures(inputCols=list(EV_COLS), lags=list(feat.LAGS), windows=list(feat.WINDOWS),
                      denseCycles=True),
        VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"),
        SQLTransformer(statement=f"SELECT *, {_RULE} AS prediction FROM __THIS__")])
    return score(model, events_panel(spark, sf).drop("ts", "event_id"), "rule", run_ts="run")


@register("batch_score_written_events", _with(f"""
SELECT unit_number, time_in_cycles, {_rs('p', 6)} AS predicted_rul,
       CASE WHEN p IS NOT NULL THEN {RISK_SQL.format(p='p')} END AS risk_level,
       'run' AS prediction_timestamp, 'rule' AS model_used FROM rule""",
    panel=EVENTS_PANEL_SQL, rule=_RULE_SQL))
def q_batch_score_written_events(spark, sf):
    """Every row scored, written and read back; a unit's first cycles have no
    prediction."""
    from cyclewise.plans.scoring import score_to
    from cyclewise.sources.streams import scratch_path
    path = scratch_path(spark, "predictions")
    score_to(_rule_scores(spark, sf), path)
    return spark.read.parquet(path).withColumn("predicted_rul", _r("predicted_rul", 6))


@register("batch_score_stats_events", _with(f"""
SELECT CAST(count(*) AS BIGINT) AS total_records, {_rs('avg(p)', 6)} AS mean_rul,
       {_rs('min(p)', 6)} AS min_rul, {_rs('max(p)', 6)} AS max_rul,
       {_rs('stddev_pop(p)', 6)} AS std_rul,
       CAST(count(*) FILTER (p < 20) AS BIGINT) AS critical_count,
       CAST(count(*) FILTER (p >= 20 AND p < 50) AS BIGINT) AS high_risk_count,
       CAST(count(*) FILTER (p >= 50 AND p < 100) AS BIGINT) AS medium_risk_count,
       CAST(count(*) FILTER (p >= 100) AS BIGINT) AS low_risk_count,
       CAST(count(*) FILTER (p IS NULL) AS BIGINT) AS unscored_count FROM rule""",
    panel=EVENTS_PANEL_SQL, rule=_RULE_SQL))
def q_batch_score_stats_events(spark, sf):
    """Statistics observed while the predictions are written, as JSON read back."""
    from cyclewise.plans.scoring import score_to
    from cyclewise.sources.streams import scratch_path
    path = scratch_path(spark, "predictions")
    stats = score_to(_rule_scores(spark, sf), path)
    # one row by nature: the statistics of the run
    io.write_metrics_json(spark.createDataFrame([stats]), path + "_stats")
    return _round_cols(spark.read.json(path + "_stats"),
                       ["mean_rul", "min_rul", "max_rul", "std_rul"], 6)

# --- W8-W10, J2, M12: sequences and neighbours -----------------------------------
from cyclewise.operators import sequences as seqs  # noqa: E402
from cyclewise.operators.knn import knn_regress  # noqa: E402

SEQ_L = 30  # window of the sequence-model comparison


def _seq_sql(cols, L, label=True):
    part = "PARTITION BY unit_number ORDER BY time_in_cycles"
    arr = ", ".join(f"CAST({c} AS DOUBLE)" for c in cols)
    if label:
        frame = f"ROWS BETWEEN {L} PRECEDING AND 1 PRECEDING"
        return (f"SELECT unit_number, time_in_cycles, seq, RUL FROM (SELECT unit_number, "
                f"time_in_cycles, RUL, flatten(list([{arr}]) OVER ({part} {frame})) AS seq FROM lp) "
                f"WHERE len(seq) = {L * len(cols)} AND RUL IS NOT NULL")
    frame = f"ROWS BETWEEN {L - 1} PRECEDING AND CURRENT ROW"
    return (f"SELECT unit_number, time_in_cycles, seq FROM (SELECT unit_number, time_in_cycles, "
            f"flatten(list([{arr}]) OVER ({part} {frame})) AS seq FROM panel) "
            f"WHERE len(seq) = {L * len(cols)}")


_LP_SQL = ("SELECT *, CAST(max(time_in_cycles) OVER (PARTITION BY unit_number) - time_in_cycles "
           "AS BIGINT) AS RUL FROM panel")


@register("sequences_events", _with(_seq_sql(EV_COLS, SEQ_L), panel=EVENTS_PANEL_SQL, lp=_LP_SQL))
def q_sequences_events(spark, sf):
    p = feat.add_rul(events_panel(spark, sf, with_max=True), max_col=MAX_CYCLE)
    return seqs.make_sequences(p, EV_COLS, SEQ_L, dense_cycles=True)


@register("inference_sequences_lineitem", _with(_seq_sql(["l_quantity", "l_discount"], 50, False),
                                                panel=LINEITEM_PANEL_SQL))
def q_inference_sequences_lineitem(spark, sf):
    return seqs.make_inference_sequences(lineitem_panel(spark, sf), ["l_quantity", "l_discount"],
                                         50, dense_cycles=True)


# kNN on integer-valued coordinates (k, value in cents): squared distances are exact in
# both engines, and ties are broken by event id on both sides.
_KNN_BASE = f"""SELECT p.event_id, [CAST(p.k AS DOUBLE), round(p.value * 100)] AS x,
  CAST(p.RUL AS DOUBLE) AS y,
  CASE WHEN {spl.split_hash_sql(['event_id'])} < 858993459 THEN 'test' ELSE 'train' END AS split
FROM lp p"""


@register("knn_regress_events", _with(f"""
SELECT event_id, {_rs('avg(y)', 4)} AS knn_pred FROM (
  SELECT q.event_id, t.y, row_number() OVER (PARTITION BY q.event_id ORDER BY
      (q.x[1] - t.x[1]) * (q.x[1] - t.x[1]) + (q.x[2] - t.x[2]) * (q.x[2] - t.x[2]), t.event_id) AS rn
  FROM kb q JOIN kb t ON q.split = 'test' AND t.split = 'train')
WHERE rn <= 5 GROUP BY event_id""", panel=EVENTS_PANEL_SQL, lp=_LP_SQL, kb=_KNN_BASE))
def q_knn_regress_events(spark, sf):
    p = feat.add_rul(events_panel(spark, sf, with_max=True), max_col=MAX_CYCLE)
    b = spl.hash_split(p, ["event_id"]).select(
        "event_id", "split", F.array(F.col("k").cast("double"), F.round(F.col("value") * 100))
        .alias("x"), F.col("RUL").cast("double").alias("y"))
    r = knn_regress(b.filter("split = 'train'"), b.filter("split = 'test'"), "x", "y",
                    "event_id", "event_id", k=5)
    return r.select("event_id", _r("knn_pred", 4).alias("knn_pred"))


@register("sequence_models_events")
def q_sequence_models_events(spark, sf):
    """Flattened L=30 windows (min-max scaled channels) -> RF, boosting, SVR (RFF), KNN;
    unshuffled 80/20 tail split; leaderboard by R^2 (O1)."""
    from pyspark.ml import PipelineModel
    from cyclewise.ml import models as mdl
    p = feat.add_rul(events_panel(spark, sf, with_max=True), max_col=MAX_CYCLE)
    p = scl.minmax_scale(p, EV_COLS)
    s = seqs.make_sequences(p, EV_COLS, SEQ_L, dense_cycles=True)
    s = spl.tail_split(s, 0.2, scope="table")
    s = seqs.flatten_sequences(s, out="scaled_features")
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    # rows dealt by their hash: the models do not depend on how AQE left the sequences
    rows = mdl.training_frame(train.select("unit_number", "time_in_cycles", "RUL", "scaled_features"))
    n, sd = mdl.label_stats(rows)
    fitted = {nm: PipelineModel(stages=mdl.fit_stages(rows, nm, n=n, label_std=sd))
              for nm in ["random_forest", "gradient_boosting", "svr"]}
    preds = mdl.predict_all(fitted, test, ["unit_number", "time_in_cycles", "RUL"])
    tk = test.select(F.concat_ws(":", "unit_number", "time_in_cycles").alias("qid"), "seq")
    tr = train.select(F.concat_ws(":", "unit_number", "time_in_cycles").alias("tid"), "seq",
                      F.col("RUL").cast("double").alias("RUL"))
    knn = knn_regress(tr, tk, "seq", "RUL", "tid", "qid", k=5)
    knn = test.select(F.concat_ws(":", "unit_number", "time_in_cycles").alias("qid"),
                      "unit_number", "time_in_cycles", "RUL").join(knn, "qid") \
        .select("unit_number", "time_in_cycles", "RUL", F.lit("knn").alias("model"),
                F.col("knn_pred").alias("prediction"))
    m = agg.regression_metrics(preds.unionByName(knn), "RUL", "prediction", by="model")
    return _round_all(ranking.leaderboard(m.select("model", "r2", "mae"), "r2"))


# --- T1-T3: streaming (file stream replayed from the tables in day order) -------
def _ev_stream_source(spark, sf):
    from cyclewise.sources.streams import replay_as_files, scratch_path
    p = events_panel(spark, sf).select("unit_number", "time_in_cycles", "value", "k",
                                       F.to_date("ts").alias("day"))
    src = scratch_path(spark, "events-stream")
    replay_as_files(p, src, "day", "unit_number")
    schema = "unit_number long, time_in_cycles long, value double, k double"
    return src, schema


@register("stream_features_events", features_sql(EVENTS_PANEL_SQL, EV_COLS, LI_IDS, rul=False,
                                                 dropna=False))
def q_stream_features_events(spark, sf):
    from cyclewise.sources.streams import scratch_path
    from cyclewise.streaming.scorer import read_stream, stream_features
    src, schema = _ev_stream_source(spark, sf)
    out, ck = scratch_path(spark, "features-out"), scratch_path(spark, "features-ck")
    st = stream_features(read_stream(spark, src, schema, max_files=4), EV_COLS)
    q = st.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck) \
        .outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return _round_features(spark.read.parquet(out), EV_COLS)


@register("stream_risk_counts_events", f"""
SELECT {RISK_SQL.format(p='value')} AS risk_level, CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1""")
def q_stream_risk_counts_events(spark, sf):
    from cyclewise.sources.streams import scratch_path
    from cyclewise.streaming.scorer import read_stream, stream_risk_counts
    src, schema = _ev_stream_source(spark, sf)
    out, ck = scratch_path(spark, "risk-out"), scratch_path(spark, "risk-ck")
    st = stream_risk_counts(read_stream(spark, src, schema, max_files=8), p="value")

    def sink(df, batch_id):  # complete mode: each batch holds the full running counts
        df.write.mode("overwrite").parquet(out)
    q = st.writeStream.outputMode("complete").foreachBatch(sink) \
        .option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)


@register("stream_score_events")
def q_stream_score_events(spark, sf):
    """T1 + T2: stream features, then a ridge model fitted on the batch feature table
    scores every micro-batch in foreachBatch; returns every row of the stream, with a NULL
    prediction and band where features are incomplete, and the count of such rows."""
    from cyclewise.ml import models as mdl
    from cyclewise.sources.streams import scratch_path
    from cyclewise.streaming.scorer import read_stream, score_stream, stream_features, \
        write_batches_to
    from cyclewise.functions.risk import risk_level as _risk
    train, _, fcols = _event_training(spark, sf)
    model = mdl.train_all(train, fcols, ["ridge"])["ridge"]
    src, schema = _ev_stream_source(spark, sf)
    out, ck = scratch_path(spark, "score-out"), scratch_path(spark, "score-ck")
    feats = stream_features(read_stream(spark, src, schema, max_files=4), EV_COLS)
    n = score_stream(feats, model, write_batches_to(out), ck)
    res = spark.read.parquet(out)
    bare = res.where("prediction IS NULL").count()
    return res.select("unit_number", "time_in_cycles", F.col("prediction").alias("predicted_rul"),
                      F.when(F.col("prediction").isNotNull(), _risk("prediction")).alias("risk_level"),
                      F.lit(n).alias("batches"), F.lit(bare).alias("unscored_count"))


# --- S1-S9: sources and sinks (round trips through the shared scratch folder) ----
from cyclewise.sources import files as io  # noqa: E402


def _scratch(spark, name):
    from cyclewise.sources.streams import scratch_path
    return scratch_path(spark, name)


@register("whitespace_roundtrip_lineitem", _with("SELECT unit_number, time_in_cycles, "
                                                 "l_quantity AS op_setting_1, l_discount AS sensor_1 "
                                                 "FROM panel", panel=LINEITEM_PANEL_SQL))
def q_whitespace_roundtrip_lineitem(spark, sf):
    p = lineitem_panel(spark, sf).select("unit_number", "time_in_cycles",
                                         F.col("l_quantity").alias("op_setting_1"),
                                         F.col("l_discount").alias("sensor_1"))
    path = _scratch(spark, "raw-text")
    io.write_whitespace(p, path)
    return io.read_whitespace(spark, path, ["unit_number", "time_in_cycles", "op_setting_1",
                                            "sensor_1"])


@register("truth_roundtrip_events", _with("""
SELECT CAST(row_number() OVER (ORDER BY unit_number) AS BIGINT) AS unit_number, RUL
FROM (SELECT unit_number, CAST(max(time_in_cycles) AS BIGINT) AS RUL FROM panel GROUP BY 1)""",
    panel=EVENTS_PANEL_SQL))
def q_truth_roundtrip_events(spark, sf):
    # a truth file is positional: one line per unit in unit order
    p = events_panel(spark, sf, with_max=True)
    truth = p.groupBy("unit_number").agg(F.max(MAX_CYCLE).alias("RUL"))
    path = _scratch(spark, "truth")
    io.write_truth(truth, path)
    return io.read_truth(spark, path)


@register("csv_roundtrip_events", _with("SELECT unit_number, time_in_cycles, value AS sensor_1, "
                                        "k AS op_setting_1 FROM panel",
                                        panel0=EVENTS_PANEL_SQL, panel=EV_NULLS_SQL))
def q_csv_roundtrip_events(spark, sf):
    p = _ev_nulls(spark, sf).select("unit_number", "time_in_cycles",
                                    F.col("value").alias("sensor_1"),
                                    F.col("k").alias("op_setting_1"))
    path = _scratch(spark, "csv")
    p.write.option("header", True).option("nullValue", "NA").csv(path)
    return io.read_panel_csv(spark, path)


@register("collection_roundtrip_part", "SELECT * FROM part")
def q_collection_roundtrip_part(spark, sf):
    from cyclewise.sources.panels import table
    part = table(spark, sf, "part")
    base = _scratch(spark, "collections")
    io.replace_collection(part.withColumn("_id", F.xxhash64("p_partkey")), base, "parts")
    return io.scan_collection(spark, base, "parts")


@register("verify_written_lineitem", _with("""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(6 AS BIGINT) AS columns,
       CAST(count(DISTINCT unit_number) AS BIGINT) AS units, true AS columns_ok FROM panel""",
    panel=LINEITEM_PANEL_SQL))
def q_verify_written_lineitem(spark, sf):
    p = lineitem_panel(spark, sf)
    path = _scratch(spark, "validated")
    io.write_table(p, path)
    return io.verify_written(spark, path, p.columns)


@register("metrics_json_roundtrip", _with(_BY_MODEL_SQL, panel=EVENTS_PANEL_SQL,
                                          fc=_forecast_sql(), lp=_LONG_SQL))
def q_metrics_json_roundtrip(spark, sf):
    m = _round_all(agg.metrics_by_model(_ev_forecasts(spark, sf), "value", MODELS))
    path = _scratch(spark, "metrics-json")
    io.write_metrics_json(m, path)
    return spark.read.schema(m.schema).json(path)


# --- O3-O5: run tables (runs derived from part: one run per brand) ----------------
from cyclewise.operators import runs as run_ops  # noqa: E402

RUN_KEYS = ["metrics.rmse", "metrics.mean_price", "params.max_size", "params.n_types"]
_RUNS_SQL = """SELECT p_brand AS run_id, stddev_pop(p_retailprice) AS "metrics.rmse",
  avg(p_retailprice) AS "metrics.mean_price", CAST(max(p_size) AS DOUBLE) AS "params.max_size",
  CAST(count(DISTINCT p_type) AS DOUBLE) AS "params.n_types" FROM part GROUP BY p_brand"""


def _runs_long(spark, sf):
    from cyclewise.sources.panels import table
    g = table(spark, sf, "part").groupBy(F.col("p_brand").alias("run_id")).agg(
        F.stddev_pop("p_retailprice").alias("m_rmse"), F.avg("p_retailprice").alias("m_price"),
        F.max("p_size").cast("double").alias("p_size"),
        F.countDistinct("p_type").cast("double").alias("p_types"))
    body = ", ".join(f"'{k}', {c}" for k, c in zip(RUN_KEYS, ["m_rmse", "m_price", "p_size",
                                                              "p_types"]))
    return run_ops.finite_metrics(g.selectExpr("run_id", f"stack(4, {body}) AS (key, value)"))


def _round_cols(df, cols, d=4):
    return df.select(*[_r(F.col(f"`{c}`"), d).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


@register("compare_runs_part", _with("SELECT run_id, " + ", ".join(
    f'{_rs(chr(34) + k + chr(34), 4)} AS "{k}"' for k in RUN_KEYS) + " FROM runs",
    runs=_RUNS_SQL))
def q_compare_runs_part(spark, sf):
    return _round_cols(run_ops.compare_runs(_runs_long(spark, sf), RUN_KEYS), RUN_KEYS)


@register("search_runs_part", _with("SELECT run_id, " + ", ".join(
    f'{_rs(chr(34) + k + chr(34), 4)} AS "{k}"' for k in RUN_KEYS) +
    ' FROM runs WHERE "params.n_types" >= 6 ORDER BY "metrics.rmse", run_id LIMIT 100',
    runs=_RUNS_SQL))
def q_search_runs_part(spark, sf):
    r = run_ops.search_runs(_runs_long(spark, sf), RUN_KEYS, "`params.n_types` >= 6")
    return _round_cols(r, RUN_KEYS)


_STAGE_SQL = ("CASE p_type WHEN 'PROMO' THEN 'Production' WHEN 'STANDARD' THEN 'Staging' "
              "WHEN 'ECONOMY' THEN 'Archived' ELSE 'None' END")


@register("latest_versions_part", f"""
SELECT p_brand AS name, CAST(max(p_size) AS BIGINT) AS latest_version FROM part
WHERE {_STAGE_SQL} IN ('Production', 'Staging') GROUP BY p_brand""")
def q_latest_versions_part(spark, sf):
    from cyclewise.sources.panels import table
    v = table(spark, sf, "part").select(F.col("p_brand").alias("name"),
                                        F.col("p_size").alias("version"),
                                        F.expr(_STAGE_SQL).alias("stage"))
    return run_ops.latest_versions(v, ["Production", "Staging"])


# --- P5, P10, M9-M11: remaining operators ----------------------------------------
@register("drop_columns_events", "SELECT event_id, ts, user_id, value FROM events")
def q_drop_columns_events(spark, sf):
    from cyclewise.sources.panels import table
    # ignore-missing drop, as for the fixed list of constant channels
    return qual.drop_columns(table(spark, sf, "events"), ["props", "event_type", "sensor_6"])


@register("clamp_residuals_events", _with(_round_sql(
    "SELECT unit_number, time_in_cycles, CASE WHEN isnan(value - mean5_rul) OR "
    "value - mean5_rul <= 0 THEN 0.0 ELSE value - mean5_rul END AS clamped FROM fc",
    ["clamped"], keep=["unit_number", "time_in_cycles"]), panel=EVENTS_PANEL_SQL, fc=_forecast_sql()))
def q_clamp_residuals_events(spark, sf):
    from cyclewise.functions.risk import clamp_rul
    r = agg.residuals(_ev_forecasts(spark, sf), "value", "mean5_rul")
    return _round_all(r.select("unit_number", "time_in_cycles",
                               clamp_rul("residual").alias("clamped")))


@register("grid_search_ridge_events")
def q_grid_search_ridge_events(spark, sf):
    """M9: 5-fold cross-validated ridge over the reference's alpha grid; one row per alpha."""
    from cyclewise.ml import models as mdl
    train, _, fcols = _event_training(spark, sf)
    cv = mdl.grid_search(mdl.training_frame(train), fcols, "ridge", parallelism=4)
    rows = [(float(a), float(m)) for a, m in zip((0.1, 1.0, 10.0, 100.0), cv.avgMetrics)]
    best = min(range(len(rows)), key=lambda i: rows[i][1])
    return spark.createDataFrame([(a, m, i == best) for i, (a, m) in enumerate(rows)],
                                 "alpha double, cv_rmse double, best boolean")


# Linear models and their grid on two standardised features of the events panel. The SQL twins work
# on sums of products per fold: ridge in closed form, lasso by coordinate descent in a recursion.
_TWO = ["value", "k"]
_TWO_FOLDS = 5
_TWO_SQL = f"""SELECT CAST({spl.split_hash_sql(['event_id'], seed=7)} % {_TWO_FOLDS} AS INT) AS fold,
  event_id, (value - m1) / s1 AS a, (k - m2) / s2 AS b, CAST(RUL AS DOUBLE) AS y
FROM lp, (SELECT avg(value) AS m1, stddev_pop(value) AS s1, avg(k) AS m2, stddev_pop(k) AS s2 FROM lp)"""
_SUM_NAMES = ["n", "sa", "sb", "sy", "saa", "sab", "sbb", "say", "sby", "syy"]
_FOLD_SUMS_SQL = """SELECT fold, CAST(count(*) AS DOUBLE) AS n, sum(a) AS sa, sum(b) AS sb, sum(y) AS sy,
  sum(a * a) AS saa, sum(a * b) AS sab, sum(b * b) AS sbb, sum(a * y) AS say, sum(b * y) AS sby,
  sum(y * y) AS syy FROM z GROUP BY fold"""
_CENTRED_SQL = """SELECT fold, n, sa / n AS ma, sb / n AS mb, sy / n AS my, saa - sa * sa / n AS aa,
  sab - sa * sb / n AS ab, sbb - sb * sb / n AS bb, say - sa * sy / n AS ay, sby - sb * sy / n AS vy
FROM t"""
_RIDGE_SQL = """SELECT fold, alpha, ((bb + alpha) * ay - ab * vy) / ((aa + alpha) * (bb + alpha) - ab * ab) AS w1,
  ((aa + alpha) * vy - ab * ay) / ((aa + alpha) * (bb + alpha) - ab * ab) AS w2 FROM c, al"""
_LASSO_STEP = "sign({p}) * greatest(abs({p}) - n * alpha, 0) / {d}"
_LASSO_SQL = f"""SELECT fold, alpha, w1, w2 FROM (
  WITH RECURSIVE it AS (
    SELECT 0 AS i, fold, alpha, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, n, aa, ab, bb, ay, vy FROM c, al
    UNION ALL
    SELECT i + 1, fold, alpha, v1, {_LASSO_STEP.format(p='(vy - ab * v1)', d='bb')}, n, aa, ab, bb, ay, vy
    FROM (SELECT *, {_LASSO_STEP.format(p='(ay - ab * w2)', d='aa')} AS v1 FROM it) WHERE i < 200)
  SELECT * FROM it WHERE i = 200)"""


def _two_features(spark, sf) -> DataFrame:
    p = feat.add_rul(events_panel(spark, sf, with_max=True), max_col=MAX_CYCLE)
    return p.select("event_id", *[F.col(c).cast("double").alias(c) for c in _TWO], "RUL")


@register("grid_search_sums_events", _with(f"""
SELECT model, alpha, {_rs('cv_mse', 4)} AS cv_mse, {_rs('cv_rmse', 4)} AS cv_rmse,
       row_number() OVER (PARTITION BY model ORDER BY cv_mse, alpha) = 1 AS best
FROM (SELECT model, alpha, avg(mse) AS cv_mse, avg(sqrt(mse)) AS cv_rmse FROM (
  SELECT w.model, w.alpha, (syy + w0 * w0 * n + w1 * w1 * saa + w2 * w2 * sbb - 2 * w0 * sy
      - 2 * w1 * say - 2 * w2 * sby + 2 * w0 * w1 * sa + 2 * w0 * w2 * sb + 2 * w1 * w2 * sab) / n AS mse
  FROM f JOIN (SELECT m.*, c.my - c.ma * w1 - c.mb * w2 AS w0 FROM c JOIN (
      SELECT 'ridge' AS model, * FROM ridge UNION ALL SELECT 'lasso', * FROM lasso) m USING (fold)) w
  USING (fold)) GROUP BY model, alpha)""",
    panel=EVENTS_PANEL_SQL, lp=_LP_SQL, z=_TWO_SQL, f=_FOLD_SUMS_SQL,
    t="SELECT f.fold, " + ", ".join(f"w.{c} - f.{c} AS {c}" for c in _SUM_NAMES) + " FROM f, (SELECT "
      + ", ".join(f"sum({c}) AS {c}" for c in _SUM_NAMES) + " FROM f) w",
    c=_CENTRED_SQL, al="SELECT unnest([0.1, 1.0, 10.0, 100.0])::DOUBLE AS alpha",
    ridge=_RIDGE_SQL, lasso=_LASSO_SQL))
def q_grid_search_sums_events(spark, sf):
    """M9: ridge and lasso over the grid of penalties, five folds by a hash of the event, all of it
    from one pass of sums."""
    from pyspark.ml.functions import vector_to_array
    from cyclewise.ml import models as mdl, moments
    from pyspark.ml import Pipeline
    rows = _two_features(spark, sf)
    scaled = Pipeline(stages=mdl.scaling_stages(_TWO)).fit(rows).transform(rows)
    sums = moments.fold_sums(scaled, vector_to_array(F.col(mdl.FEATURES)), F.col("RUL"),
                             spl.split_hash(["event_id"], seed=7) % _TWO_FOLDS, len(_TWO))
    table = [(m, r["alpha"], r["cv_mse"], r["cv_rmse"], r["best"])
             for m in ("ridge", "lasso") for r in moments.grid_from_sums(sums, m)]
    out = spark.createDataFrame(table, "model string, alpha double, cv_mse double, cv_rmse double, best boolean")
    return out.select("model", "alpha", _r("cv_mse", 4).alias("cv_mse"), _r("cv_rmse", 4).alias("cv_rmse"), "best")


@register("linear_coefficients_events", _with(f"""
SELECT model, {_rs('my - ma * w1 - mb * w2', 3)} AS intercept, {_rs('w1', 3)} AS w_value, {_rs('w2', 3)} AS w_k
FROM c JOIN (SELECT 'linear_regression' AS model, * FROM ridge WHERE alpha = 0
             UNION ALL SELECT 'ridge', * FROM ridge WHERE alpha = 1
             UNION ALL SELECT 'lasso', * FROM lasso WHERE alpha = 1) m USING (fold)""",
    panel=EVENTS_PANEL_SQL, lp=_LP_SQL, z=_TWO_SQL.replace(f"% {_TWO_FOLDS}", "% 1"), t=_FOLD_SUMS_SQL,
    c=_CENTRED_SQL, al="SELECT unnest([0.0, 1.0])::DOUBLE AS alpha", ridge=_RIDGE_SQL, lasso=_LASSO_SQL))
def q_linear_coefficients_events(spark, sf):
    """M5, M6, M7: coefficients of the fitted pipelines' regressors, on standardised features."""
    from cyclewise.ml import models as mdl
    fitted = mdl.train_all(_two_features(spark, sf), _TWO, ["linear_regression", "ridge", "lasso"])
    table = [(name, float(m.stages[-1].intercept), *map(float, m.stages[-1].coefficients.toArray()))
             for name, m in fitted.items()]
    out = spark.createDataFrame(table, "model string, intercept double, w_value double, w_k double")
    return out.select("model", *[_r(c, 3).alias(c) for c in ("intercept", "w_value", "w_k")])


_FITTED_SQL = """SELECT model, my - ma * w1 - mb * w2 AS w0, w1, w2 FROM c JOIN (
  SELECT 'linear_regression' AS model, * FROM ridge WHERE alpha = 0
  UNION ALL SELECT 'ridge', * FROM ridge WHERE alpha = 1) m USING (fold)"""
_FITTED_CTES = dict(panel=EVENTS_PANEL_SQL, lp=_LP_SQL, z=_TWO_SQL.replace(f"% {_TWO_FOLDS}", "% 1"),
                    t=_FOLD_SUMS_SQL, c=_CENTRED_SQL, al="SELECT unnest([0.0, 1.0])::DOUBLE AS alpha",
                    ridge=_RIDGE_SQL, fitted=_FITTED_SQL)


def _fitted_two(spark, sf):
    from cyclewise.ml import models as mdl
    rows = _two_features(spark, sf)
    return rows, mdl.train_all(rows, _TWO, ["linear_regression", "ridge"])


@register("compare_fitted_models_events", _with(f"""
SELECT event_id, {_rs('l', 3)} AS linear_regression_rul, {_rs('r', 3)} AS ridge_rul,
       {_rs('(l + r) / 2', 3)} AS ensemble_rul
FROM (SELECT event_id, max(w0 + w1 * a + w2 * b) FILTER (model = 'ridge') AS r,
             max(w0 + w1 * a + w2 * b) FILTER (model = 'linear_regression') AS l
      FROM z, fitted GROUP BY event_id)""", **_FITTED_CTES))
def q_compare_fitted_models_events(spark, sf):
    """Fitted models side by side on the same rows, and their mean."""
    from cyclewise.ml import models as mdl
    rows, fitted = _fitted_two(spark, sf)
    out = mdl.compare_models(fitted, rows, ["event_id"])
    return out.select("event_id", *[_r(c, 3).alias(c) for c in out.columns if c.endswith("_rul")])


@register("training_metrics_models_events", _with("SELECT model, mse, rmse, mae, r2 FROM (" + _metrics_sql(
    "y", "p", "(SELECT model, y, w0 + w1 * a + w2 * b AS p FROM z, fitted) s", "model") + ") m", **_FITTED_CTES))
def q_training_metrics_models_events(spark, sf):
    """A2: mse, rmse, mae and r2 of every fitted model on its own training rows."""
    from cyclewise.ml import models as mdl
    rows, fitted = _fitted_two(spark, sf)
    return _metrics_out(mdl.training_metrics_all(fitted, rows), ["mse", "rmse", "mae", "r2"])


# --- L1: the whole training flow on the 26-column panel -------------------------------------
def _raw_events_sql() -> str:
    return (f"SELECT unit_number, time_in_cycles, {', '.join(f'{e} AS {c}' for c, e in RAW_FROM_EVENTS.items())} "
            "FROM ev")


@register("training_table_raw_events", features_sql(
    "SELECT * FROM (" + _with(_raw_events_sql(), ev=EVENTS_PANEL_SQL) + ")",
    feature_base_columns(list(RAW_FROM_EVENTS)), LI_IDS))
def q_training_table_raw_events(spark, sf):
    """26 raw columns, eight constant channels dropped, 16 channels, 176 features."""
    from cyclewise.plans.training import feature_table, training_channels
    raw = raw_panel(spark, sf)
    cols = training_channels(raw)
    ft, fcols = feature_table(raw, cols, dense_cycles=True, decimals=4)
    if len(cols) != 16 or len(fcols) != 176:
        raise ValueError(f"{len(cols)} channels, {len(fcols)} features")
    return ft.select("unit_number", "time_in_cycles", "RUL", *fcols)


@register("training_flow_events")
def q_training_flow_events(spark, sf):
    """L1: validate, repair, features, split, scale, fit every model, evaluate, write; the report read
    back, one row per model with its training and test metrics."""
    from cyclewise.plans.training import read_report, run_training
    out = _scratch(spark, "training-run")
    run_training(raw_panel(spark, sf), out)
    report, training = read_report(spark, out)
    test = report.select(F.explode("detailed_metrics").alias("model", "m"), "best_model", "recommendations")
    train = training.select(F.explode("training_metrics").alias("model", "t"))
    return test.join(train, "model").select(
        "model", _r("t.rmse", 3).alias("train_rmse"), _r("m.rmse", 3).alias("test_rmse"),
        _r("m.r2", 4).alias("test_r2"), (F.col("best_model.name") == F.col("model")).alias("best"),
        F.col("recommendations")[0].alias("recommendation"))


@register("evaluation_report_events", _with(f"""
SELECT m.model, m.rmse, m.r2, {_rs('s.avg_rmse')} AS avg_rmse, {_rs('s.best_r2')} AS best_r2, b.model AS best,
       CASE WHEN b.r2 > 0.9 THEN concat('Excellent performance! ', b.model, ' achieves R2 > 0.9')
            WHEN b.r2 > 0.7 THEN concat('Good performance. Consider feature engineering to improve ', b.model)
            ELSE 'Consider additional feature engineering or trying ensemble methods' END AS recommendation
FROM by_model m, (SELECT avg(rmse) AS avg_rmse, max(r2) AS best_r2 FROM by_model) s,
     (SELECT model, r2 FROM by_model ORDER BY rmse, model_order LIMIT 1) b""",
    panel=EVENTS_PANEL_SQL, fc=_forecast_sql(), lp=_LONG_SQL, by_model=f"SELECT * FROM ({_BY_MODEL_SQL})"))
def q_evaluation_report_events(spark, sf):
    """The nested report of all models, written as JSON and read back."""
    from cyclewise.plans.training import evaluation_report, write_report
    out = _scratch(spark, "report")
    metrics = _round_all(agg.metrics_by_model(_ev_forecasts(spark, sf), "value", MODELS))
    report = evaluation_report(metrics)
    write_report(report, out)
    back = spark.read.schema(report.schema).json(out)
    return back.select(F.explode("detailed_metrics").alias("model", "m"), "*").select(
        "model", "m.rmse", "m.r2", _r("summary.avg_rmse").alias("avg_rmse"), _r("summary.best_r2").alias("best_r2"),
        F.col("best_model.name").alias("best"), F.col("recommendations")[0].alias("recommendation"))


@register("evaluate_saved_models_events")
def q_evaluate_saved_models_events(spark, sf):
    """M10 + S10 + M11: train, save, rediscover every saved model, evaluate all on the test split."""
    from cyclewise.ml import models as mdl
    train, test, fcols = _event_training(spark, sf)
    path = _scratch(spark, "models")
    mdl.save_models(mdl.train_all(train, fcols, ["linear_regression", "ridge", "lasso"]), path)
    return _metrics_out(mdl.evaluate_all(mdl.load_models(path), test))


@register("correlation_lineitem_vector", ORACLE["correlation_lineitem"])
def q_correlation_lineitem_vector(spark, sf):
    """A8 through ml.stat.Correlation (the path for wide feature sets)."""
    from cyclewise.sources.panels import table
    return _round_all(agg.correlation_matrix_vector(table(spark, sf, "lineitem"), _CORR_COLS))

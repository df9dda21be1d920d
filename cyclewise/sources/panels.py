"""Panels derived from the driver's tables (the test data ships no sensor table).

* ``events_panel``: unit = ``user_id``; cycle = row position by (ts, event_id);
  setting ``k`` from the ``props`` JSON; channel ``value``.
* ``lineitem_panel``: unit = ``l_suppkey``; cycle = row position by
  (l_shipdate, l_orderkey, l_linenumber, l_partkey); channels quantity, price,
  discount, tax.

Cycle positions come from the skew-safe ``with_position`` so a supplier or user
holding a third of all rows is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.operators.position import time_bucket, with_position
from cyclewise.schema import CONSTANT_CHANNELS, CYCLE, UNIT, sensor_columns

EVENT_CHANNELS = ["value", "k"]
LINEITEM_CHANNELS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


MAX_CYCLE = "_max_cycle"


def events_panel(spark: SparkSession, sf_dir: str, bucket_seconds: int = 86400,
                 with_max: bool = False) -> DataFrame:
    """``with_max`` adds ``_max_cycle`` (the unit's last cycle) for ``add_rul(max_col=...)``."""
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias(UNIT), "ts", "event_id", "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"))
    p = with_position(ev, UNIT, ["ts", "event_id"], time_bucket("ts", bucket_seconds), out=CYCLE,
                      total_out=MAX_CYCLE if with_max else None)
    return p.select(UNIT, CYCLE, "event_id", "ts", *EVENT_CHANNELS,
                    *([MAX_CYCLE] if with_max else []))


def lineitem_panel(spark: SparkSession, sf_dir: str, bucket_seconds: int = 30 * 86400,
                   with_max: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias(UNIT), "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
        *LINEITEM_CHANNELS)
    p = with_position(li, UNIT, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"],
                      time_bucket("l_shipdate", bucket_seconds), out=CYCLE,
                      total_out=MAX_CYCLE if with_max else None)
    return p.select(UNIT, CYCLE, *LINEITEM_CHANNELS, *([MAX_CYCLE] if with_max else []))


def _raw_channels() -> dict[str, str]:
    """The 24 channels of the raw layout as expressions on the events panel (both engines): the
    channels without variance are constants, the others mix the value with a stir of the event."""
    out = {"op_setting_1": "value + k", "op_setting_2": "CAST(event_id % 7 AS DOUBLE)",
           "op_setting_3": "CAST(100 AS DOUBLE)"}
    for i, c in enumerate(sensor_columns(), 1):
        out[c] = (f"CAST({500 + i} AS DOUBLE)" if c in CONSTANT_CHANNELS else
                  f"value + CAST((event_id * {37 * i + 11}) % 1009 AS DOUBLE)")
    return out


RAW_FROM_EVENTS = _raw_channels()


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel in the raw 26-column layout, derived from the events table."""
    return events_panel(spark, sf_dir).selectExpr(
        UNIT, CYCLE, *[f"{e} AS {c}" for c, e in RAW_FROM_EVENTS.items()])


# DuckDB twins of the panels, used as CTEs by the oracle SQL.
EVENTS_PANEL_SQL = """
SELECT user_id AS unit_number,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS time_in_cycles,
       event_id, ts, value,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
FROM events"""

LINEITEM_PANEL_SQL = """
SELECT l_suppkey AS unit_number,
       CAST(row_number() OVER (PARTITION BY l_suppkey
            ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS BIGINT) AS time_in_cycles,
       l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem"""

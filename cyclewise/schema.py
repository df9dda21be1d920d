"""Panel schema: canonical column names and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

UNIT = "unit_number"
CYCLE = "time_in_cycles"
TARGET = "RUL"

# --- fixed values (must equal the reference's for equal results) -------------
# Raw panel layout: unit, cycle, three operational settings, 21 sensors.
N_SETTINGS = 3
N_SENSORS = 21
# Channels without variance that are removed before feature engineering.
CONSTANT_CHANNELS = ["sensor_6", "op_setting_3", "sensor_1", "sensor_5",
                     "sensor_10", "sensor_16", "sensor_18", "sensor_19"]
# Feature configuration.
LAGS = [1, 3, 6, 12]
WINDOWS = [5, 10, 20]
TEST_SIZE = 0.2
SEED = 42
SEQUENCE_LENGTH = 50
# Identifier aliases accepted in place of unit / cycle.
UNIT_ALIASES = ["unit", "unit_id", "engine_id", "id"]
CYCLE_ALIASES = ["cycle", "time", "cycles", "time_cycle"]
# Identifier names coerced to integers by the list-form type check.
INTEGER_ID_NAMES = ["unit_number", "time_in_cycles", "unit", "unit_id", "engine_id",
                    "id", "cycle", "time", "cycles"]
# Risk bands on predicted RUL: below 20 CRITICAL, below 50 HIGH, below 100 MEDIUM, else LOW.
RISK_BANDS = [(20.0, "CRITICAL"), (50.0, "HIGH"), (100.0, "MEDIUM")]
RISK_DEFAULT = "LOW"
RISK_LEVELS = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
# Evaluation-report recommendation on the best model's R^2 ({model} = its name).
RECOMMEND_EXCELLENT = (0.9, "Excellent performance! {model} achieves R2 > 0.9")
RECOMMEND_GOOD = (0.7, "Good performance. Consider feature engineering to improve {model}")
RECOMMEND_OTHER = "Consider additional feature engineering or trying ensemble methods"
# Fill constants for columns that are null in every row.
NUMERIC_FILL = 0
STRING_FILL = "unknown"
# Scoring micro-batch size.
STREAM_BATCH = 1000
# -----------------------------------------------------------------------------


def setting_columns(n: int = N_SETTINGS) -> list[str]:
    return [f"op_setting_{i}" for i in range(1, n + 1)]


def sensor_columns(n: int = N_SENSORS) -> list[str]:
    return [f"sensor_{i}" for i in range(1, n + 1)]


def raw_columns() -> list[str]:
    return [UNIT, CYCLE] + setting_columns() + sensor_columns()


def raw_schema() -> T.StructType:
    """Typed schema of the 26-column raw panel."""
    return T.StructType(
        [T.StructField(UNIT, T.LongType()), T.StructField(CYCLE, T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in setting_columns() + sensor_columns()])


def channel_columns(columns: list[str]) -> list[str]:
    """Setting/sensor channels in a column list (the serving-side selection)."""
    return [c for c in columns if c.startswith("sensor_") or c.startswith("op_setting_")]


def feature_base_columns(columns: list[str]) -> list[str]:
    """Channels kept for feature engineering: sensors then settings, minus constant ones."""
    sensors = [c for c in columns if c.startswith("sensor_") and c not in CONSTANT_CHANNELS]
    settings = [c for c in columns if c.startswith("op_setting_") and c not in CONSTANT_CHANNELS]
    return sensors + settings

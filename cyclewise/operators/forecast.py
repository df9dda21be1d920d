"""Naive per-unit forecasters used as comparison models (last value, trailing means).

Each prediction only looks back (rows before the current one), so it runs in
the same bounded (unit, block) windows as the feature operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.operators.features import halo_window
from cyclewise.schema import CYCLE, UNIT

# model name -> number of previous rows averaged (1 = last value)
NAIVE_MODELS = {"last": 1, "mean3": 3, "mean5": 5, "mean10": 10}


def naive_forecasts(df: DataFrame, col: str, models: dict[str, int] = NAIVE_MODELS,
                    suffix: str = "_rul", unit: str = UNIT, cycle: str = CYCLE,
                    dense_cycles: bool = False, **kw) -> DataFrame:
    """Append ``{model}{suffix}`` = mean of the previous n values of ``col`` in the unit."""
    def build(w, pos):
        return [F.avg(col).over(w.rowsBetween(-n, -1)).alias(f"{m}{suffix}")
                for m, n in models.items()]
    return halo_window(df, build, max(models.values()), unit, cycle, dense_cycles, **kw)

"""Batch scoring (L2): load -> transform -> risk bands -> write, with stats from the same pass."""

from __future__ import annotations

import datetime as _dt

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cyclewise.functions.risk import risk_level
from cyclewise.operators.aggregates import prediction_stat_exprs
from cyclewise.schema import CYCLE, UNIT
from cyclewise.sources.files import write_predictions


def complete_features(model: PipelineModel, scored: DataFrame) -> Column:
    """True where every numeric input of the model's assembler is present. Some models return
    a number for a row with missing inputs, so the prediction itself cannot tell."""
    ok = F.lit(True)
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            for c in stage.getInputCols():
                if c in scored.columns:
                    x = F.col(c).cast("double")
                    ok = ok & x.isNotNull() & ~F.isnan(x)
    return ok


def score(model: PipelineModel, panel: DataFrame, model_name: str, unit: str = UNIT,
          cycle: str = CYCLE, run_ts: str | None = None) -> DataFrame:
    """Predictions: ids, predicted_rul, risk_level, prediction_timestamp, model_used.

    Every row of the panel is returned; one whose lag/rolling features are incomplete (a
    unit's first cycles) or whose prediction is NaN has a NULL prediction and band. The
    timestamp is taken once on the driver per job (one value per run), not per row.
    """
    ts = run_ts or _dt.datetime.now().isoformat()
    out = model.transform(panel)
    p = F.when(complete_features(model, out) & ~F.isnan("prediction"), F.col("prediction"))
    return out.select(unit, cycle, p.alias("predicted_rul")) \
        .select(unit, cycle, "predicted_rul",
                F.when(F.col("predicted_rul").isNotNull(), risk_level("predicted_rul"))
                .alias("risk_level"),
                F.lit(ts).alias("prediction_timestamp"), F.lit(model_name).alias("model_used"))


def score_to(scored: DataFrame, path: str) -> dict:
    """Write scored rows; returns their statistics (A3) and the count of rows without a
    prediction, observed in the pass that writes."""
    seen = Observation()
    stats = [*prediction_stat_exprs("predicted_rul"),
             F.count_if(F.col("predicted_rul").isNull()).alias("unscored_count")]
    write_predictions(scored.observe(seen, *stats), path)
    return seen.get

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cyclewise.functions.risk import clamp_rul, risk_level
from cyclewise.operators import aggregates as agg


def _pairs(spark, y, p):
    return spark.createDataFrame(pd.DataFrame({"y": np.asarray(y, float), "p": np.asarray(p, float)}))


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(42)
    y = rng.uniform(10, 200, 100)
    p = y + rng.normal(0, 10, 100)
    m = agg.regression_metrics(_pairs(spark, y, p), "y", "p").first()
    e = y - p
    assert math.isclose(m.mse, np.mean(e ** 2), rel_tol=1e-9)
    assert math.isclose(m.rmse, np.sqrt(np.mean(e ** 2)), rel_tol=1e-9)
    assert math.isclose(m.mae, np.mean(np.abs(e)), rel_tol=1e-9)
    r2 = 1 - np.sum(e ** 2) / np.sum((y - y.mean()) ** 2)
    assert math.isclose(m.r2, r2, rel_tol=1e-9)
    assert math.isclose(m.mape, np.mean(np.abs(e) / np.abs(y)) * 100, rel_tol=1e-9)
    assert math.isclose(m.smape, 100 * np.mean(2 * np.abs(e) / (np.abs(y) + np.abs(p) + 1e-8)), rel_tol=1e-9)
    assert math.isclose(m.std_error, np.std(e), rel_tol=1e-9)
    assert m.mse >= 0 and m.mae >= 0


def test_perfect_and_constant(spark):
    y = [100.0, 150.0, 200.0, 50.0, 75.0]
    m = agg.regression_metrics(_pairs(spark, y, y), "y", "p").first()
    assert m.mse == 0 and m.r2 == 1.0 and m.max_error == 0
    c = agg.regression_metrics(_pairs(spark, [0.0, 0.0], [1.0, 1.0]), "y", "p").first()
    assert c.r2 == 0.0 and math.isinf(c.mape)


def test_best_model_and_summary(spark):
    m = spark.createDataFrame([("model_a", 15.5, 0.85, 1), ("model_b", 12.3, 0.90, 2),
                               ("model_c", 18.2, 0.80, 3)], "model string, rmse double, r2 double, model_order long")
    b = agg.best_model(m).first()
    assert b.name == "model_b" and b.recommendation.startswith("Good performance")
    s = agg.evaluation_summary(m).first()
    assert s.total_models_evaluated == 3 and s.best_rmse == 12.3 and s.best_r2 == 0.90


def test_risk_bands(spark):
    vals = [10, 5, 30, 45, 60, 90, 150, 200, 20, 50, 100, -5, float("nan"), None]
    exp = ["CRITICAL", "CRITICAL", "HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "HIGH", "MEDIUM",
           "LOW", "CRITICAL", "LOW", "LOW"]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "p double")
    got = [r.r for r in df.select(risk_level("p").alias("r")).collect()]
    assert got == exp
    cl = [r.c for r in df.select(clamp_rul("p").alias("c")).collect()]
    assert cl[11] == 0.0 and cl[12] == 0.0 and cl[0] == 10.0 and cl[13] is None


def test_prediction_stats_bands_sum(spark):
    df = spark.createDataFrame([(float(v),) for v in range(0, 300, 7)], "predicted_rul double")
    s = agg.prediction_stats(df).first()
    assert s.critical_count + s.high_risk_count + s.medium_risk_count + s.low_risk_count == s.total_records


def test_histogram_and_corr(spark):
    df = spark.createDataFrame([(float(v), float(2 * v)) for v in range(100)], "x double, y double")
    h = agg.histogram(df, "x", 10).orderBy("bin").collect()
    assert [r["count"] for r in h] == [10] * 10
    c = {(r.col_a, r.col_b): r.corr for r in agg.correlation_matrix(df, ["x", "y"]).collect()}
    assert abs(c[("x", "y")] - 1) < 1e-12


def test_ensemble_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a_rul double, b_rul double, c_rul double")
    r = agg.ensemble_mean(df).collect()
    assert r[0].ensemble_rul == 2.0 and r[1].ensemble_rul is None


def test_histogram_keeps_every_row(spark):
    import math
    from cyclewise.operators.aggregates import histogram
    hi = 0.7318
    rows = [(0.1,), (math.nextafter(hi, 0),), (hi,), (float("nan"),), (None,)]
    df = spark.createDataFrame(rows, "x double")
    for bins in (3, 7, 50, 1000):
        assert sum(r["count"] for r in histogram(df, "x", bins).collect()) == 3


def test_nan_predictions_reach_no_band(spark):
    from cyclewise.operators.aggregates import prediction_stats, regression_metrics
    df = spark.createDataFrame([(10.0, 11.0), (120.0, float("nan")), (60.0, 60.0)], "y double, p double")
    s = prediction_stats(df, "p").first()
    assert (s.total_records, s.low_risk_count, s.max_rul) == (3, 0, 60.0)
    assert abs(regression_metrics(df, "y", "p").first()["mae"] - 0.5) < 1e-12

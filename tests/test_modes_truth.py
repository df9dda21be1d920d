"""Modes by heavy hitters, truth files over blocks, the whole training flow."""

import collections
import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.operators import fill, modes
from cyclewise.sources import files as io


def brute(values):
    n = collections.Counter(v for v in values if v is not None)
    return min((-c, v) for v, c in n.items())[1] if n else None


@pytest.mark.parametrize("capacity", [1, 3, 50, 4096])
def test_modes_equal_a_full_count(spark, capacity):
    rng = random.Random(capacity)
    rows = [(rng.choice(["a", "b", "é", None, f"x{rng.randrange(200)}"]), rng.randrange(300),
             rng.choice([-1.5, 2.25, 1e300, None]), None, rng.choice([10, 9, None])) for _ in range(900)]
    df = spark.createDataFrame(rows, "t string, i long, d double, n string, k int").repartition(6)
    cols = ["t", "i", "d", "n", "k"]
    want = {c: brute([r[j] for r in rows]) for j, c in enumerate(cols)}
    assert modes.column_modes(df, cols, capacity) == {c: v for c, v in want.items() if v is not None}
    assert modes.column_modes(df.limit(0), cols) == {}


def test_mode_of_a_million_distinct_values(spark):
    """Flat but for one value: proven by the summaries, or counted in full where they cannot."""
    df = spark.range(1_000_000).select(F.when(F.col("id") % 50 == 0, F.lit("hot")).otherwise(
        F.col("id").cast("string")).alias("v"), F.col("id").alias("flat"))
    assert modes.column_modes(df, ["v", "flat"]) == {"v": "hot", "flat": 0}


def test_shrunk_summary_is_low_by_no_more_than_its_error():
    rng = np.random.default_rng(1)
    true = {str(k): int(n) for k, n in enumerate(rng.integers(1, 50, 400))}
    kept, error = modes.shrink(dict(true), 40)
    assert len(kept) <= 40 and all(true[v] - error == n for v, n in kept.items())
    assert all(n <= error for v, n in true.items() if v not in kept)


def test_fill_remaining_mode(spark):
    df = spark.createDataFrame([("a", 1.0, None), (None, None, None), ("b", 2.0, None), ("b", 2.0, None)],
                               "s string, x double, z string")
    got = fill.fill_remaining(df, strategy="mode").collect()
    assert [tuple(r) for r in got] == [("a", 1.0, "unknown"), ("b", 2.0, "unknown"), ("b", 2.0, "unknown"), ("b", 2.0, "unknown")]


def test_truth_over_files_and_blocks(spark, tmp_path):
    values = [7 * k % 1001 for k in range(5000)]
    truth = spark.createDataFrame([(10 * k, v) for k, v in enumerate(values)], "unit_number long, RUL long").repartition(7)
    io.write_truth(truth, str(tmp_path / "t"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # many blocks a file
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = io.read_truth(spark, str(tmp_path / "t"))
        assert got.rdd.getNumPartitions() >= 1
        rows = sorted((r.unit_number, r.RUL) for r in got.collect())
        blocks = spark.read.text(str(tmp_path / "t")).select("_metadata.file_block_start").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert rows == [(k + 1, v) for k, v in enumerate(values)] and blocks > 3
    (tmp_path / "one.txt").write_text("  5 \n\nx\n6\n")
    assert [tuple(r) for r in io.read_truth(spark, str(tmp_path / "one.txt")).orderBy("unit_number").collect()] == [
        (1, 5), (2, None), (3, 6)]


def test_whole_training_flow(spark, sensor_df, tmp_path):
    """26 raw columns to predictions, metrics and the nested report, written and read back."""
    from cyclewise.plans import training as tr
    out = str(tmp_path / "run")
    models = tr.run_training(sensor_df, out, names=["ridge", "random_forest"], num_trees=3)
    report, metrics = (x.first() for x in tr.read_report(spark, out))
    assert report.summary.total_models_evaluated == 2 and set(report.detailed_metrics) == set(models)
    best = min(report.detailed_metrics, key=lambda m: report.detailed_metrics[m].rmse)
    assert report.best_model.name == best and report.best_model.rmse == report.summary.best_rmse
    assert len(report.recommendations) == 1
    assert metrics.training_metrics["random_forest"].rmse < report.detailed_metrics["random_forest"].rmse
    wide = spark.read.parquet(f"{out}/predictions")
    assert wide.columns == ["unit_number", "time_in_cycles", "RUL", "ridge_rul", "random_forest_rul", "ensemble_rul"]
    for r in wide.collect():
        assert np.isclose(r.ensemble_rul, (r.ridge_rul + r.random_forest_rul) / 2)
    from cyclewise.ml import models as mdl
    back = mdl.load_models(f"{out}/models", spark=spark)
    assert set(back) == set(models)
    with pytest.raises(ValueError):
        tr.run_training(sensor_df.drop("sensor_3"), out)


def test_training_flow_fits_every_model(spark, tmp_path, monkeypatch):
    """The registered flow leaves out none of the catalogue's models; only their sizes are less here."""
    from cyclewise.ml import models as mdl
    from cyclewise.plans import training as tr
    from cyclewise.plans.queries import QUERIES
    whole = tr.run_training
    monkeypatch.setattr(tr, "run_training", lambda *a, **kw: whole(*a, **kw, num_trees=3, gbt_iter=3, rff_dim=16))
    rng = np.random.default_rng(4)
    rows = [(40 * u + i, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=i), u, float(rng.normal(50, 10)),
             '{"k": %d}' % rng.integers(10)) for u in range(5) for i in range(40)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, value double, props string").write.parquet(
        str(tmp_path / "events.parquet"))
    got = {r.model: r for r in QUERIES["training_flow_events"](spark, str(tmp_path)).collect()}
    assert sorted(got) == sorted(mdl.MODEL_NAMES) and sum(r.best for r in got.values()) == 1
    assert all(np.isfinite([r.train_rmse, r.test_rmse, r.test_r2]).all() for r in got.values())


def test_train_and_evaluate_and_serve(spark, sensor_df):
    from cyclewise.plans import training as tr
    from cyclewise.plans.scoring import score
    cols = tr.training_channels(sensor_df)
    assert len(cols) == 16
    models, metrics, training, report = tr.train_and_evaluate(sensor_df, cols, names=["ridge", "lasso"])
    assert {r.model for r in metrics.collect()} == {r.model for r in training.collect()} == {"ridge", "lasso"}
    assert report.first().summary.total_models_evaluated == 2
    served = score(tr.serving_model(models["lasso"], cols), sensor_df, "lasso", run_ts="t").collect()
    assert len(served) == 100 and sum(r.predicted_rul is not None for r in served) == 40

import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cyclewise.operators import features as feat
from cyclewise.streaming.scorer import read_stream, rolling_mean_std, stream_features


def test_rolling_mean_std_equals_pandas():
    x = np.array([1.0, 2.0, np.nan, 4.0, 8.0, 16.0, 3.0])
    m, s = rolling_mean_std(x, 3)
    r = pd.Series(x).rolling(3, min_periods=1)
    np.testing.assert_allclose(m, r.mean().to_numpy(), equal_nan=True)
    np.testing.assert_allclose(s, r.std().to_numpy(), equal_nan=True)


def test_stream_features_equal_batch_and_drop_late(spark):
    rng = np.random.default_rng(1)
    rows = [(u, c, float(rng.integers(0, 50))) for u in range(1, 4) for c in range(1, 31)]
    base = tempfile.mkdtemp(prefix="cw-stream-")
    src = os.path.join(base, "src")
    # three arrival slices in cycle order, one append job each; then a late duplicate
    for lo, hi in [(1, 10), (11, 20), (21, 30)]:
        part = [r for r in rows if lo <= r[1] <= hi]
        spark.createDataFrame(part, "unit_number long, time_in_cycles long, s double") \
            .repartition(2, "unit_number").write.mode("append").parquet(src)
    spark.createDataFrame([(1, 5, 99.0)], "unit_number long, time_in_cycles long, s double") \
        .write.mode("append").parquet(src)
    st = stream_features(read_stream(spark, src, "unit_number long, time_in_cycles long, s double",
                                     max_files=2), ["s"], [1, 3], [5])
    out = os.path.join(base, "out")
    q = st.writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.parquet(out).toPandas().sort_values(["unit_number", "time_in_cycles"])
    batch = feat.window_features(spark.createDataFrame(rows, "unit_number long, time_in_cycles long, s double"),
                                 ["s"], [1, 3], [5], dense_cycles=True).toPandas() \
        .sort_values(["unit_number", "time_in_cycles"])
    assert len(got) == 90  # the late row (unit 1, cycle 5) is dropped
    for c in ["s_lag_1", "s_lag_3", "s_rolling_mean_5", "s_rolling_std_5"]:
        np.testing.assert_array_equal(got[c].to_numpy(float), batch[c].to_numpy(float))


def test_stream_features_counts_dropped_rows(spark):
    schema = "unit_number long, time_in_cycles long, s double"
    base = tempfile.mkdtemp(prefix="cw-stream-")
    src, out = os.path.join(base, "src"), os.path.join(base, "out")
    # one repeat inside the first batch, one late row in the second
    for part in [[(1, 1, 1.0), (1, 2, 2.0), (1, 2, 5.0)], [(1, 1, 9.0), (1, 3, 3.0)]]:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
    st = stream_features(read_stream(spark, src, schema), ["s"], [1], [2], dropped="dropped")
    st.writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True) \
        .start().awaitTermination()
    got = spark.read.parquet(out).orderBy("time_in_cycles").collect()
    assert [(r.time_in_cycles, r.dropped) for r in got] == [(1, 1), (2, 1), (3, 2)]


def test_stream_score_returns_every_row(spark):
    """Incomplete rows (a unit's first 12 cycles, all of a short unit) have no prediction."""
    from cyclewise.plans.queries import QUERIES
    from cyclewise.sources.panels import events_panel
    sf = "/root/testdata/sf0.001"
    got = QUERIES["stream_score_events"](spark, sf).toPandas()
    want = events_panel(spark, sf).select("unit_number", "time_in_cycles").toPandas()
    assert sorted(zip(got.unit_number, got.time_in_cycles)) == sorted(zip(want.unit_number, want.time_in_cycles))
    bare = got.time_in_cycles <= 12
    assert bare.any() and (got.predicted_rul.isna() == bare).all() and (got.risk_level.isna() == bare).all()
    assert (got.unscored_count == bare.sum()).all()


def test_online_scoring_clamps_the_value_and_bands_the_raw_one(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer, VectorAssembler
    from cyclewise.streaming.scorer import read_stream, score_stream
    rows = [(1, -7.5), (2, 0.0), (3, 19.0), (4, 120.0), (5, None)]
    spark.createDataFrame(rows, "id long, x double").coalesce(1).write.parquet(str(tmp_path / "in"))
    model = PipelineModel(stages=[
        VectorAssembler(inputCols=["x"], outputCol="features", handleInvalid="keep"),
        SQLTransformer(statement="SELECT *, x AS prediction FROM __THIS__")])
    got = []
    n = score_stream(read_stream(spark, str(tmp_path / "in"), "id long, x double"), model,
                     lambda df, k: got.extend(df.select("id", "prediction", "risk_level").collect()),
                     str(tmp_path / "ck"), online=True)
    assert n == 1
    assert sorted(map(tuple, got)) == [(1, 0.0, "CRITICAL"), (2, 0.0, "CRITICAL"), (3, 19.0, "CRITICAL"),
                                       (4, 120.0, "LOW"), (5, None, None)]


def test_units_of_a_bucket_keep_their_own_state(spark, tmp_path):
    """Many units, one without a name, share two buckets: calls of the function follow the buckets,
    and features, gaps and dropped rows stay those of each unit."""
    from cyclewise.streaming import scorer
    rng = np.random.default_rng(4)
    schema = "unit_number long, time_in_cycles long, s double"
    rows = [(u, c, None if rng.integers(9) == 0 else float(rng.normal()))
            for u in [None, *range(1, 40)] for c in range(1, 26)]
    for lo, hi in [(1, 9), (10, 10), (11, 25)]:
        part = [r for r in rows if lo <= r[1] <= hi] + ([(7, 3, 1.0), (None, 2, 1.0)] if lo == 10 else [])
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
    st = stream_features(read_stream(spark, str(tmp_path / "src"), schema), ["s"], [1, 6], [5, 20],
                         dropped="dropped", buckets=2)
    assert "_bucket" in st._jdf.queryExecution().toString() and scorer.BUCKETS < 1000
    st.writeStream.format("parquet").option("path", str(tmp_path / "out")) \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = feat.window_features(spark.createDataFrame(rows, schema), ["s"], [1, 6], [5, 20], dense_cycles=True)
    bits = lambda df: sorted(tuple(v.hex() if isinstance(v, float) else repr(v) for v in r)
                             for r in df.collect())
    assert bits(got.drop("dropped")) == bits(want)
    late = {(r.unit_number, r.dropped) for r in got.where("time_in_cycles > 10").collect()}
    assert late == {(u, int(u in (7, None))) for u in [None, *range(1, 40)]}


def test_replay_reads_each_slice_alone(spark, tmp_path):
    from cyclewise.sources.streams import replay_as_files
    df = spark.createDataFrame([(u, d, u + d) for u in range(1, 9) for d in range(1, 4)], "u long, d long, v long")
    assert replay_as_files(df, str(tmp_path / "src"), "d", "u", 2) == 3
    files = spark.read.parquet(str(tmp_path / "src")).select("*", F.input_file_name().alias("f")).collect()
    assert sorted((r.u, r.v) for r in files) == sorted((u, u + d) for u in range(1, 9) for d in range(1, 4))
    assert all(len({r.v - r.u for r in files if r.f == f}) == 1 for f in {r.f for r in files})

import math

import numpy as np
from pyspark.sql import functions as F

from cyclewise.operators import scale, split


def test_hash_split_disjoint_and_stable(sensor_df):
    s = split.hash_split(sensor_df, ["unit_number", "time_in_cycles"]).toPandas()
    assert set(s.split) == {"train", "test"} and len(s) == 100
    again = split.hash_split(sensor_df.repartition(3), ["unit_number", "time_in_cycles"]).toPandas()
    m = s.merge(again, on=["unit_number", "time_in_cycles"])
    assert (m.split_x == m.split_y).all()


def test_exact_split_size(sensor_df):
    s = split.hash_split(sensor_df, ["unit_number", "time_in_cycles"], exact=True)
    assert s.filter("split = 'test'").count() == math.ceil(100 * 0.2)


def test_tail_split(sensor_df):
    t = split.tail_split(sensor_df, 0.2, scope="table").toPandas()
    test = t[t.split == "test"]
    assert len(test) == 20 and set(test.unit_number) == {5}
    u = split.tail_split(sensor_df, 0.2, scope="unit", block_rows=4).toPandas()
    assert (u[u.split == "test"].time_in_cycles > 16).all() and (u.split == "test").sum() == 20


def test_standard_scale_population(sensor_df, sensor_pdf):
    out = scale.standard_scale(sensor_df, ["sensor_2"]).toPandas()
    x = sensor_pdf.sensor_2.to_numpy()
    exp = (x - x.mean()) / x.std()  # ddof=0
    np.testing.assert_allclose(np.sort(out.sensor_2.to_numpy()), np.sort(exp), atol=1e-12)


def test_minmax_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    r = scale.minmax_scale(df, ["a", "c"]).collect()
    assert [x.a for x in r] == [0.0, 1.0] and [x.c for x in r] == [0.0, 0.0]


def test_vector_scalers(spark):
    from pyspark.ml.feature import VectorAssembler
    from cyclewise.ml.stages import PopulationStandardScaler, ZeroSafeMinMaxScaler
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (5.0, 7.0)], "a double, b double")
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    s = PopulationStandardScaler().fit(v).transform(v).select("scaled_features").collect()
    a = np.array([r[0].toArray() for r in s])
    np.testing.assert_allclose(a[:, 0], (np.array([1, 3, 5]) - 3) / np.std([1, 3, 5]))
    assert (a[:, 1] == 0).all()
    m = ZeroSafeMinMaxScaler().fit(v).transform(v).select("scaled_features").collect()
    assert [r[0][0] for r in m] == [0.0, 0.5, 1.0]


def test_hash_split_meets_small_fractions(spark):
    from cyclewise.operators.split import hash_split
    df = spark.range(50_000).withColumnRenamed("id", "k")
    for size in (0.004, 0.125):
        n = hash_split(df, ["k"], test_size=size).where("split = 'test'").count()
        assert abs(n / 50_000 - size) < 0.1 * size + 0.001

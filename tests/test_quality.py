import math

from pyspark.sql import functions as F

from cyclewise.operators import quality as q
from cyclewise.operators.ranking import union_panels


def test_check_columns(sensor_df):
    from cyclewise.schema import raw_columns
    assert q.check_columns(sensor_df, {"schema": {"columns": raw_columns()}})["ok"]
    r = q.check_columns(sensor_df.drop("sensor_5"), raw_columns())
    assert not r["ok"] and r["missing"] == ["sensor_5"]
    assert q.check_columns(sensor_df.withColumn("x", F.lit(1)), raw_columns())["extra"] == ["x"]


def test_coerce_list_and_dict(spark):
    df = spark.createDataFrame([("1", "2.5", "abc", "NaN"), ("2.0", "3", " 7 ", "1e3"), ("1.5", None, "x", "")],
                               "unit_number string, time_in_cycles string, sensor_1 string, op_setting_1 string")
    r = q.coerce_types(df).collect()
    assert r[0]["unit_number"] == 1 and r[0]["time_in_cycles"] is None  # fractional id -> NULL
    assert r[0]["sensor_1"] is None and r[0]["op_setting_1"] is None    # text, NaN -> NULL
    assert r[1]["op_setting_1"] == 1000.0 and r[2]["unit_number"] is None
    d = q.coerce_types(df, {"sensor_1": {"dtype": "float64"}, "unit_number": "int64"}).collect()
    assert d[1]["sensor_1"] == 7.0 and d[1]["unit_number"] == 2
    rep = q.coerce_report(df).first()
    assert rep["sensor_1"] == 2 and rep["time_in_cycles"] == 1


def test_clip_keeps_null_and_counts(spark):
    df = spark.createDataFrame([(1.0,), (None,), (50.0,), (-3.0,)], "x double")
    assert q.count_out_of_range(df, {"x": (0.0, 10.0)}).first()["x"] == 2
    got = [r.x for r in q.clip_ranges(df, {"x": (0.0, 10.0)}).collect()]
    assert got == [1.0, None, 10.0, 0.0]


def test_duplicates_fixture(sensor_df):
    five = sensor_df.orderBy("unit_number", "time_in_cycles").limit(5)
    both = union_panels(sensor_df, five)
    assert both.count() == 105
    assert q.duplicate_count(both).first()["duplicates"] == 5
    assert q.drop_duplicates(both).count() == 100


def test_zscore(spark):
    vals = [float(i % 10) for i in range(200)] + [1000.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = q.zscore_outliers(df, "x", 3).collect()
    assert [r.x for r in out] == [1000.0]


def test_constant_and_all_null(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, 5.0, None)], "a long, b double, c double")
    assert q.constant_columns(df) == ["b"]
    assert q.drop_all_null_columns(df).columns == ["a", "b"]


def test_profile(sensor_df):
    p = q.profile_columns(sensor_df).collect()
    assert len(p) == 26 and all(r.row_count == 100 and r.distinct_units == 5 for r in p)
    assert all(r.null_count == 0 for r in p)


def test_slice_units(sensor_df):
    assert q.slice_units(sensor_df, n=2).select("unit_number").distinct().count() == 2
    assert q.slice_units(sensor_df, units=[3]).count() == 20
    assert not math.isnan(1.0)

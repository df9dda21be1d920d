import numpy as np
import pandas as pd

from cyclewise.operators import fill


def _panel(spark):
    rng = np.random.default_rng(7)
    rows = []
    for u in range(1, 9):
        for c in range(1, 11):
            v = float(rng.integers(0, 100))
            rows.append((u, c, None if rng.random() < 0.6 else v, None if rng.random() < 0.85 else v))
    pdf = pd.DataFrame(rows, columns=["unit_number", "time_in_cycles", "a", "b"])
    # build from Python rows: None must become NULL (pandas would turn it into NaN)
    return pdf, spark.createDataFrame(rows, "unit_number long, time_in_cycles long, a double, b double")


def test_unit_scope_matches_pandas(spark):
    pdf, df = _panel(spark)
    exp = pdf.sort_values(["unit_number", "time_in_cycles"]).copy()
    for c in ["a", "b"]:
        g = exp.groupby("unit_number")[c]
        exp[c] = g.ffill()
        exp[c] = exp.groupby("unit_number")[c].bfill()
    for block in (1 << 18, 3):
        got = fill.fill_nulls(df, ["a", "b"], scope="unit", block_rows=block).toPandas() \
            .sort_values(["unit_number", "time_in_cycles"])
        for c in ["a", "b"]:
            np.testing.assert_array_equal(got[c].to_numpy(float), exp[c].to_numpy(float))


def test_table_scope_matches_pandas(spark):
    pdf, df = _panel(spark)
    exp = pdf.sort_values(["unit_number", "time_in_cycles"]).ffill().bfill()
    for block, dense in ((1 << 18, True), (4, False)):
        got = fill.fill_nulls(df, ["a", "b"], scope="table", block_rows=block,
                              dense_cycles=dense).toPandas().sort_values(["unit_number", "time_in_cycles"])
        for c in ["a", "b"]:
            np.testing.assert_array_equal(got[c].to_numpy(float), exp[c].to_numpy(float))


def test_fill_remaining_constants_and_mean(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (2, 3.0, None, None)],
                               "id long, a double, s string, t string")
    r = fill.fill_remaining(df).orderBy("id").collect()
    assert r[0]["a"] == 0 and r[0]["s"] == "unknown" and r[1]["t"] == "unknown"
    m = fill.fill_remaining(df, strategy="mean").orderBy("id").collect()
    assert m[0]["a"] == 3.0 and m[1]["t"] == "x"


def test_reference_null_fixture(spark):
    # A = 1, 2, -, 4, 5 ; B = -, 2, 3, 4, 5 in one unit
    df = spark.createDataFrame([(1, i + 1, a, b) for i, (a, b) in enumerate(
        [(1.0, None), (2.0, 2.0), (None, 3.0), (4.0, 4.0), (5.0, 5.0)])],
        "unit_number long, time_in_cycles long, A double, B double")
    r = fill.repair(df, ["A", "B"]).orderBy("time_in_cycles").toPandas()
    assert r["A"].tolist() == [1, 2, 2, 4, 5] and r["B"].tolist() == [2, 2, 3, 4, 5]

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cyclewise.operators.position import value_bucket, with_position

rows = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40)), min_size=1, max_size=60,
                unique=True)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows, width=st.sampled_from([1, 3, 7, 100]))
def test_position_equals_row_number(spark, rows, width):
    df = spark.createDataFrame(rows, "u long, c long")
    got = with_position(df, "u", ["c"], value_bucket("c", width), out="pos", total_out="n").toPandas()
    pdf = pd.DataFrame(rows, columns=["u", "c"]).sort_values(["u", "c"])
    pdf["pos"] = pdf.groupby("u").cumcount() + 1
    pdf["n"] = pdf.groupby("u")["c"].transform("size")
    m = got.merge(pdf, on=["u", "c"], suffixes=("", "_exp"))
    assert len(m) == len(rows)
    assert (m.pos == m.pos_exp).all() and (m.n == m.n_exp).all()


def test_null_unit_rows_kept(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 1)], "u long, c long")
    got = with_position(df, "u", ["c"], F.col("c"), out="pos").collect()
    assert len(got) == 3 and sorted(r.pos for r in got if r.u is None) == [1, 2]


def test_range_scan_matches_pandas(spark):
    import numpy as np
    from cyclewise.operators.position import range_scan, with_global_position
    rng = np.random.default_rng(5)
    rows = [(int(u), int(b), float(rng.integers(1, 9)), None if rng.random() < 0.6 else float(rng.integers(0, 99)))
            for u in range(6) for b in range(7)]
    df = spark.createDataFrame(rows, "u long, b long, n double, v double")
    got = range_scan(df, ["u", "b"], sums=["n"], carries=["v"], parts=4).toPandas() \
        .sort_values(["u", "b"]).reset_index(drop=True)
    exp = pd.DataFrame(rows, columns=["u", "b", "n", "v"]).sort_values(["u", "b"]).reset_index(drop=True)
    exp["pre"] = exp["n"].cumsum() - exp["n"]
    exp["prev"] = exp["v"].shift(1).ffill()
    exp["next"] = exp["v"][::-1].shift(1).ffill()[::-1]
    assert (got["_pre_n"].to_numpy() == exp["pre"].to_numpy()).all()
    np.testing.assert_array_equal(got["_prev_v"].to_numpy(float), exp["prev"].to_numpy(float))
    np.testing.assert_array_equal(got["_next_v"].to_numpy(float), exp["next"].to_numpy(float))
    gp = with_global_position(df, ["u", "b"], F.col("u"), out="pos", total_out="tot").toPandas() \
        .sort_values(["u", "b"])
    assert gp["pos"].tolist() == list(range(1, len(rows) + 1)) and (gp["tot"] == len(rows)).all()

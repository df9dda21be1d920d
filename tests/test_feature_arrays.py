"""Rolling features in arrays against window expressions and F.round, bit for bit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclewise.operators import features as feat

SCHEMA = "unit_number long, time_in_cycles long, tag string, a double, b double"


def rows(seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for u in [None, *range(1, 9)]:
        for c in range(1, int(rng.integers(2, 90))):
            a = [None, float("nan"), float("inf"), 0.1 * float(rng.integers(0, 9)), float(rng.normal() * 1e5)][
                rng.choice(5, p=[0.05, 0.02, 0.01, 0.4, 0.52])]
            out.append((u, c, None if c % 7 == 0 else f"t{c}", a, float(rng.integers(0, 3))))
    return out


def by_windows(df, cols, lags, windows, dense, block):
    """The features as window expressions."""
    from pyspark.sql import Window  # noqa: F401
    halo = max([0] + lags + [n - 1 for n in windows])

    def build(w, pos):
        e = [F.lag(c, k).over(w).alias(feat.lag_name(c, k)) for c in cols for k in lags]
        for c in cols:
            for n in windows:
                m, s = feat.rolling_names(c, n)
                e += [F.avg(c).over(w.rowsBetween(1 - n, 0)).alias(m),
                      F.stddev_samp(c).over(w.rowsBetween(1 - n, 0)).alias(s)]
        return e
    return feat.halo_window(df, build, halo, dense_cycles=dense, block_rows=block)


def bits(df):
    return sorted((tuple(v.hex() if isinstance(v, float) else repr(v) for v in r) for r in df.collect()))


@pytest.mark.parametrize("dense,block,batch", [(True, 1 << 18, 10000), (True, 16, 7), (False, 9, 3)])
def test_arrays_equal_windows(spark, dense, block, batch):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.createDataFrame(rows(), SCHEMA)
    cols, lags, windows = ["a", "b"], [1, 3, 12], [1, 5, 20]
    assert feat.in_arrays(df, cols, "unit_number")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        plain = feat.window_features(df, cols, lags, windows, dense_cycles=dense, block_rows=block)
        assert "MapInArrow" in plain._jdf.queryExecution().toString()
        want = by_windows(df, cols, lags, windows, dense, block)
        assert plain.schema == want.schema
        assert bits(plain) == bits(want)
        names = feat.feature_names(cols, lags, windows)
        m = 1e4
        want = want.na.drop("any").withColumns({c: F.round(F.col(c) * m) / m for c in names})
        got = feat.window_features(df, cols, lags, windows, dense_cycles=dense, block_rows=block, decimals=4,
                                   complete=True)
        assert bits(got) == bits(want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_whole_numbers_keep_their_type(spark):
    df = spark.createDataFrame([(u, c, c * c, None if c == 3 else 0.5) for u in (1, 2) for c in range(1, 9)],
                               "unit_number int, time_in_cycles long, a int, b float")
    got = feat.window_features(df, ["a", "b"], [2], [3], dense_cycles=True)
    want = by_windows(df, ["a", "b"], [2], [3], True, 1 << 18)
    assert got.schema == want.schema and bits(got) == bits(want)


def test_rounding_equals_spark_round(spark):
    x = [0.5, -0.5, 1.5, -1.5, 2.5, -2.5, 0.49999999999999994, -0.2, -0.0, 0.0, 1e300, 4503599627370497.5,
         9007199254740993.0, float("nan"), float("inf"), -float("inf"), None, 123.45675, -123.45675, 0.00005]
    df = spark.createDataFrame([(v,) for v in x], "x double").coalesce(1)
    for d in (0, 4):
        m = float(10 ** d)
        got = [r for r in df.select(feat.rounded("x", d), F.round(F.col("x") * m) / m).collect()]
        assert [None if a is None else a.hex() for a, _ in got] == [None if b is None else b.hex() for _, b in got]
        array = feat.rounded_array(np.array([v for v in x if v is not None]), d)
        assert [v.hex() for v in array.tolist()] == [b.hex() for _, b in got if b is not None]

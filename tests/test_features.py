import math

import numpy as np
import pandas as pd

from cyclewise.operators import features as feat


def _feature_row(history, lags, windows):
    """Features of a unit's latest reading, from the list of its readings so far."""
    row = {}
    for k in lags:
        row[f"lag_{k}"] = history[-1 - k] if len(history) > k else math.nan
    for n in windows:
        recent = history[-n:]
        mean = math.fsum(recent) / len(recent)
        squares = math.fsum((x - mean) ** 2 for x in recent)
        row[f"rolling_mean_{n}"] = mean
        row[f"rolling_std_{n}"] = math.sqrt(squares / (len(recent) - 1)) if len(recent) > 1 else math.nan
    return row


def _brute_force(pdf, cols, lags, windows):
    readings = {}
    for record in pdf.to_dict("records"):
        readings.setdefault(record["unit_number"], []).append(record)
    rows = []
    for records in readings.values():
        records.sort(key=lambda r: r["time_in_cycles"])
        for at, record in enumerate(records, start=1):
            row = dict(record)
            for c in cols:
                history = [r[c] for r in records[:at]]
                row.update({f"{c}_{name}": v for name, v in _feature_row(history, lags, windows).items()})
            rows.append(row)
    return pd.DataFrame(rows)


def _sorted(pdf):
    return pdf.sort_values(["unit_number", "time_in_cycles"]).reset_index(drop=True)


def test_lags_and_rolling_match_brute_force(sensor_df, sensor_pdf):
    cols = ["sensor_2", "sensor_3"]
    exp = _sorted(_brute_force(sensor_pdf, cols, [1, 3], [5, 10]))
    for dense, block in [(True, 1 << 18), (False, 1 << 18), (True, 4), (False, 3)]:
        got = _sorted(feat.window_features(sensor_df, cols, [1, 3], [5, 10], dense_cycles=dense,
                                           block_rows=block).toPandas())
        for c in feat.feature_names(cols, [1, 3], [5, 10]):
            np.testing.assert_allclose(got[c].astype(float), exp[c].astype(float), atol=1e-9,
                                       equal_nan=True, err_msg=f"{c} dense={dense} block={block}")


def test_rul_invariants(sensor_df):
    for method in ("join", "window"):
        r = feat.add_rul(sensor_df, method=method).toPandas()
        assert (r["RUL"] >= 0).all()
        last = r.loc[r.groupby("unit_number")["time_in_cycles"].idxmax()]
        assert (last["RUL"] == 0).all()
        assert r.loc[r.time_in_cycles == 1, "RUL"].eq(19).all()


def test_feature_table_drops_first_cycles(sensor_df):
    cols = ["sensor_2"]
    t = feat.build_feature_table(sensor_df, cols, dense_cycles=True)
    assert t.count() == 5 * (20 - 12)  # max lag 12 removes the first 12 cycles per unit


def test_short_unit_removed(spark):
    pdf = pd.DataFrame({"unit_number": [1] * 12 + [2] * 15, "time_in_cycles": list(range(1, 13)) + list(range(1, 16)),
                        "s": np.arange(27, dtype=float)})
    t = feat.build_feature_table(spark.createDataFrame(pdf), ["s"], dense_cycles=True).toPandas()
    assert set(t.unit_number) == {2} and len(t) == 3


def test_gapped_cycles_use_row_positions(spark):
    pdf = pd.DataFrame({"unit_number": [1] * 6, "time_in_cycles": [1, 2, 5, 9, 10, 30],
                        "s": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]})
    got = feat.add_lags(spark.createDataFrame(pdf), ["s"], [1], block_rows=2).toPandas() \
        .sort_values("time_in_cycles")
    assert got["s_lag_1"].tolist()[1:] == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_drop_incomplete_counts_what_it_drops(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (None, 4.0)],
                               "a long, x double")
    rows, seen = feat.drop_incomplete(df, observe=True)
    assert [tuple(r) for r in rows.collect()] == [(1, 1.0)]
    assert seen.get == {"dropped": 3}

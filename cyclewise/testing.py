"""Result comparison used by tests and the oracle check script."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd


def _norm_scalar(v, digits):
    if v is None or (isinstance(v, float) and np.isnan(v)):
        return "NULL"
    if isinstance(v, (float, np.floating)):
        if np.isinf(v):
            return "inf" if v > 0 else "-inf"
        r = round(float(v), digits)
        return repr(0.0 if r == 0 else r)
    if isinstance(v, (list, tuple, np.ndarray)):
        return "[" + ",".join(_norm_scalar(x, digits) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm_scalar(x, digits)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, pd.Timestamp):
        return str(v.tz_localize(None) if v.tzinfo else v)
    return str(v)


def _norm_column(s: pd.Series, digits: int) -> pd.Series:
    if pd.api.types.is_float_dtype(s):
        a = s.to_numpy(dtype="float64", na_value=np.nan)
        r = np.round(a, digits) + 0.0
        out = pd.Series([repr(x) for x in r.tolist()], index=s.index)
        out[np.isnan(a)] = "NULL"
        out[np.isposinf(a)] = "inf"
        out[np.isneginf(a)] = "-inf"
        return out
    if pd.api.types.is_integer_dtype(s) or pd.api.types.is_bool_dtype(s):
        return s.astype("object").map(lambda v: "NULL" if pd.isna(v) else str(int(v)))
    return s.map(lambda v: _norm_scalar(v, digits))


def normalized_rows(df: pd.DataFrame, digits: int = 4) -> tuple[list[str], list[str]]:
    cols = sorted(df.columns)
    if not len(df):
        return cols, []
    parts = [_norm_column(df[c].reset_index(drop=True), digits) for c in cols]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows + "|" + p
    return cols, sorted(rows.tolist())


def compare_frames(a: pd.DataFrame, b: pd.DataFrame, digits: int = 4) -> tuple[bool, str]:
    ca, ra = normalized_rows(a, digits)
    cb, rb = normalized_rows(b, digits)
    if ca != cb:
        return False, f"columns differ: {ca} vs {cb}"
    if len(ra) != len(rb):
        return False, f"rows differ: {len(ra)} vs {len(rb)}"
    ha = hashlib.sha256("\n".join(ra).encode()).hexdigest()
    hb = hashlib.sha256("\n".join(rb).encode()).hexdigest()
    if ha != hb:
        bad = sum(x != y for x, y in zip(ra, rb))
        for x, y in zip(ra, rb):
            if x != y:
                return False, f"{bad} rows differ, e.g. {x[:300]} vs {y[:300]}"
    return True, f"rows={len(ra)}"

"""Risk banding, RUL clamping and report recommendation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclewise.schema import (RECOMMEND_EXCELLENT, RECOMMEND_GOOD, RECOMMEND_OTHER, RISK_BANDS,
                              RISK_DEFAULT)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def risk_level(pred) -> Column:
    """CRITICAL < 20 <= HIGH < 50 <= MEDIUM < 100 <= LOW. NaN and NULL compare false -> LOW."""
    p = _c(pred)
    e = None
    for bound, name in RISK_BANDS:
        e = F.when(p < F.lit(bound), F.lit(name)) if e is None else e.when(p < F.lit(bound), F.lit(name))
    return e.otherwise(F.lit(RISK_DEFAULT))


def clamp_rul(pred) -> Column:
    """max(0, pred) with Python semantics: NaN -> 0 (``greatest`` would keep NaN)."""
    p = _c(pred)
    return F.when(F.isnan(p) | (p <= F.lit(0.0)), F.lit(0.0)).otherwise(p.cast("double"))


def recommendation(r2, model) -> Column:
    """Report recommendation text for the best model's R^2."""
    r, m = _c(r2), _c(model)
    (t1, s1), (t2, s2) = RECOMMEND_EXCELLENT, RECOMMEND_GOOD
    fmt = lambda s: F.replace(F.lit(s), F.lit("{model}"), m)
    return F.when(r > F.lit(t1), fmt(s1)).when(r > F.lit(t2), fmt(s2)).otherwise(F.lit(RECOMMEND_OTHER))

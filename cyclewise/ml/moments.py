"""Linear models and their grid search from sums (M5-M7, M9).

Least squares, ridge and lasso need no rows once the sums of products of (1, x, y) are known, and
the sums of any set of folds add up. One pass over the table takes a (d + 2)^2 matrix per fold in
every task; Spark adds them up cell by cell. Every fold and penalty is then solved on the driver
from matrices whose size is the number of features alone: ridge by a linear system, lasso by
coordinate descent on the same matrix, and the error on a held-out fold is a quadratic form of
that fold's matrix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PENALTIES = (0.1, 1.0, 10.0, 100.0)  # fixed values: the reference's grid of alpha


def fold_sums(df: DataFrame, x: Column, y: Column, fold: Column, width: int) -> dict[int, np.ndarray]:
    """Sum of z z' with z = (1, x, y) for each fold; ``x`` is an array of ``width`` doubles. Rows
    with a null label are left out."""
    size = width + 2
    low, high = np.triu_indices(size)

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = np.asarray(batch.column(0))
            z = np.ones((batch.num_rows, size))
            z[:, 1:-1] = np.asarray(batch.column(1).flatten(), np.float64).reshape(-1, width)
            z[:, -1] = np.asarray(batch.column(2))
            for f in np.unique(folds).tolist():
                part = z[folds == f]
                sums[f] = sums.get(f, 0) + part.T @ part
        for f, m in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"fold": pa.array([f] * len(low), pa.int32()), "i": pa.array(low, pa.int32()),
                 "j": pa.array(high, pa.int32()), "v": pa.array(m[low, high])})

    frame = df.select(fold.cast("int").alias("fold"), x.alias("x"), y.cast("double").alias("y")).where("y is not null")
    total = frame.mapInArrow(run, "fold int, i int, j int, v double").groupBy("fold", "i", "j").agg(
        F.sum("v").alias("v"))
    out: dict[int, np.ndarray] = {}
    for r in total.collect():  # folds x (features + 2)^2 / 2 numbers
        m = out.setdefault(r.fold, np.zeros((size, size)))
        m[r.i, r.j] = m[r.j, r.i] = r.v
    return dict(sorted(out.items()))


def centred(sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, means and centred products of (x, y)."""
    n = sums[0, 0]
    mean = sums[0, 1:] / n
    return n, mean, sums[1:, 1:] - n * np.outer(mean, mean)


def ridge(sums: np.ndarray, alpha: float) -> tuple[float, np.ndarray]:
    """Intercept and coefficients that minimise |y - b - Xw|^2 + alpha |w|^2."""
    _, mean, s = centred(sums)
    a = s[:-1, :-1] + alpha * np.eye(len(s) - 1)
    w = np.linalg.solve(a, s[:-1, -1]) if alpha > 0 else np.linalg.lstsq(a, s[:-1, -1], rcond=None)[0]
    return mean[-1] - mean[:-1] @ w, w


def lasso(sums: np.ndarray, alpha: float, tol: float = 1e-12, sweeps: int = 100_000) -> tuple[float, np.ndarray]:
    """Intercept and coefficients that minimise |y - b - Xw|^2 / (2 n) + alpha |w|_1, by coordinate
    descent until no coefficient moves by more than ``tol`` of the largest."""
    n, mean, s = centred(sums)
    a, target = s[:-1, :-1], s[:-1, -1]
    w, product = np.zeros(len(a)), np.zeros(len(a))  # product = a @ w
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(w)):
            if a[j, j] <= 0:
                continue
            pull = target[j] - product[j] + a[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - n * alpha, 0.0) / a[j, j]
            if new != w[j]:
                moved = max(moved, abs(new - w[j]))
                product += a[:, j] * (new - w[j])
                w[j] = new
        if moved <= tol * max(np.abs(w).max(), 1.0):
            break
    return mean[-1] - mean[:-1] @ w, w


def mean_squared_error(sums: np.ndarray, intercept: float, w: np.ndarray) -> float:
    """Mean of (y - b - x'w)^2 over the rows of ``sums``."""
    a = np.concatenate([[-intercept], -w, [1.0]])
    return max(float(a @ sums @ a) / sums[0, 0], 0.0)


SOLVERS = {"ridge": ridge, "lasso": lasso}


def grid_from_sums(sums: dict[int, np.ndarray], name: str, alphas=PENALTIES) -> list[dict]:
    """M9: for each penalty the mean over folds of the held-out mean squared error and of its root,
    and whether it is the best (least mean squared error, first of equals)."""
    whole = sum(sums.values())
    rows = []
    for alpha in alphas:
        errors = [mean_squared_error(m, *SOLVERS[name](whole - m, alpha)) for m in sums.values()]
        rows.append({"alpha": float(alpha), "cv_mse": float(np.mean(errors)),
                     "cv_rmse": float(np.mean(np.sqrt(errors)))})
    best = min(range(len(rows)), key=lambda k: rows[k]["cv_mse"])
    return [r | {"best": k == best} for k, r in enumerate(rows)]

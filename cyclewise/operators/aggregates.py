"""Aggregations: regression metrics, prediction statistics, evaluation report,
histograms, correlations and overviews (A1-A10, P15, P16, J3).

Each is a single ``agg`` (partial aggregation map-side, then one small
exchange); grouped variants shuffle only the partial states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclewise.functions.risk import recommendation, risk_level
from cyclewise.schema import CYCLE, TARGET, UNIT

SMAPE_EPS = 1e-8  # fixed value: symmetric-MAPE denominator guard


def residuals(df: DataFrame, y: str, p: str, out: str = "residual") -> DataFrame:
    """actual - predicted."""
    return df.withColumn(out, F.col(y) - F.col(p))


def metric_exprs(y: str, p: str) -> list[Column]:
    """mse, rmse, mae, r2, mape, smape, max/min abs error, population std of error."""
    yy, pp = F.col(y), F.col(p)
    e = yy - pp
    ae = F.abs(e)
    n = F.count(F.lit(1))
    ss_res = F.sum(e * e)
    ss_tot = F.var_pop(yy) * n
    r2 = F.when(ss_tot == 0, F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0))) \
        .otherwise(F.lit(1.0) - ss_res / ss_tot)
    nz = yy != 0
    mape = F.when(F.count_if(nz) > 0, F.avg(F.when(nz, ae / F.abs(yy))) * 100.0) \
        .otherwise(F.lit(float("inf")))
    smape = 100.0 * F.avg(2.0 * ae / (F.abs(yy) + F.abs(pp) + F.lit(SMAPE_EPS)))
    return [F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(ae).alias("mae"),
            r2.alias("r2"), mape.alias("mape"), smape.alias("smape"),
            F.max(ae).alias("max_error"), F.min(ae).alias("min_error"),
            F.stddev_pop(e).alias("std_error")]


def regression_metrics(df: DataFrame, y: str, p: str, by: list[str] | str | None = None) -> DataFrame:
    """A1: one row (or one per ``by`` group) of regression metrics."""
    d = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull()
                  & ~F.isnan(F.col(y).cast("double")) & ~F.isnan(F.col(p).cast("double")))
    if by:
        return d.groupBy(*([by] if isinstance(by, str) else by)).agg(*metric_exprs(y, p))
    return d.agg(*metric_exprs(y, p))


def training_metrics(df: DataFrame, y: str, p: str, by: str | None = None) -> DataFrame:
    """A2: mse, rmse, mae, r2 on the training rows, or one row per ``by`` group."""
    return regression_metrics(df, y, p, by).select(*([by] if by else []), "mse", "rmse", "mae", "r2")


def prediction_stat_exprs(p: str) -> list[Column]:
    x = F.when(~F.isnan(F.col(p).cast("double")), F.col(p))
    return [F.count(F.lit(1)).cast("long").alias("total_records"),
            F.avg(x).alias("mean_rul"), F.min(x).alias("min_rul"), F.max(x).alias("max_rul"),
            F.stddev_pop(x).alias("std_rul"),
            F.count_if(x < 20).cast("long").alias("critical_count"),
            F.count_if((x >= 20) & (x < 50)).cast("long").alias("high_risk_count"),
            F.count_if((x >= 50) & (x < 100)).cast("long").alias("medium_risk_count"),
            F.count_if(x >= 100).cast("long").alias("low_risk_count")]


def prediction_stats(df: DataFrame, p: str = "predicted_rul") -> DataFrame:
    """A3: count, mean, min, max, population std and count per risk band. A NaN prediction
    is counted in the total only."""
    return df.agg(*prediction_stat_exprs(p))


def ensemble_mean(df: DataFrame, suffix: str = "_rul", out: str = "ensemble_rul") -> DataFrame:
    """Row-wise mean of all ``*{suffix}`` columns, skipping NULLs."""
    cols = [c for c in df.columns if c.endswith(suffix) and c != out]
    s = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols), F.lit(0.0))
    n = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return df.withColumn(out, F.when(n > 0, s / n))


def long_predictions(df: DataFrame, y: str, models: list[str], suffix: str = "_rul",
                     ids: list[str] = (UNIT, CYCLE)) -> DataFrame:
    """Side-by-side predictions -> (ids, y, model, prediction)."""
    pairs = ", ".join(f"'{m}', `{m}{suffix}`" for m in models)
    return df.selectExpr(*ids, y, f"stack({len(models)}, {pairs}) AS (model, prediction)")


def metrics_by_model(df: DataFrame, y: str, models: list[str], suffix: str = "_rul") -> DataFrame:
    """A1 grouped by model over side-by-side predictions, with registration order."""
    long = long_predictions(df, y, models, suffix, ids=[])
    order = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model")).cast("long")
    return regression_metrics(long, y, "prediction", by="model") \
        .withColumn("model_order", order)


def evaluation_summary(metrics: DataFrame) -> DataFrame:
    """A4: model count, mean rmse / r2, best rmse / r2."""
    return metrics.agg(F.count(F.lit(1)).cast("long").alias("total_models_evaluated"),
                       F.avg("rmse").alias("avg_rmse"), F.avg("r2").alias("avg_r2"),
                       F.min("rmse").alias("best_rmse"), F.max("r2").alias("best_r2"))


def best_model(metrics: DataFrame, order_col: str = "model_order") -> DataFrame:
    """A5 + A6: lowest rmse (first registered on ties) and its recommendation."""
    w = Window.orderBy(F.col("rmse").asc(), F.col(order_col).asc())  # one row per model
    b = metrics.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1")
    return b.select(F.col("model").alias("name"), "rmse", "r2",
                    recommendation("r2", "model").alias("recommendation"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width counts over [min, max]; last bin closed; empty bins kept. NULL and NaN
    count nowhere; a value that rounds up to the last edge belongs to the last bin.

    min/max come from one aggregate; each row then gets its bin by arithmetic,
    counts are pre-aggregated map-side, and the ``bins``-row frame of all bins
    (bounded by ``bins``) is joined to keep empty ones.
    """
    x = F.col(col).cast("double")
    df = df.filter(x.isNotNull() & ~F.isnan(x))
    mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin bigint, bin_start double, bin_end double, count bigint")
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.lit(bins - 1).cast("long"), F.floor((x - F.lit(lo)) / F.lit(width)).cast("long")) \
        if hi > lo else F.lit(0).cast("long")
    counts = df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = spark.range(bins).select(
        F.col("id").alias("bin"),
        (F.lit(lo) + F.col("id") * F.lit(width)).alias("bin_start"),
        (F.lit(lo) + (F.col("id") + 1) * F.lit(width)).alias("bin_end"))
    return edges.join(F.broadcast(counts), "bin", "left") \
        .select("bin", "bin_start", "bin_end", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, one aggregate, long form."""
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    body = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return row.selectExpr(f"stack({len(pairs)}, {body}) AS (col_a, col_b, corr)")


def correlation_matrix_vector(df: DataFrame, cols: list[str]) -> DataFrame:
    """A8 for wide inputs: Pearson matrix from ``ml.stat.Correlation`` over an assembled
    vector (one distributed pass); the d x d result (bounded by the column count) is
    returned in the same long form as ``correlation_matrix``. Rows with a NULL are skipped."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation
    vec = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="skip").transform(df)
    m = Correlation.corr(vec, "_v").first()[0].toArray()
    rows = [(a, b, float(m[i][j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def dataset_overview(df: DataFrame, unit: str = UNIT, exclude=(UNIT, CYCLE, TARGET)) -> DataFrame:
    """Samples, feature count, distinct units."""
    nfeat = len([c for c in df.columns if c not in exclude])
    return df.agg(F.count(F.lit(1)).cast("long").alias("samples"),
                  F.lit(nfeat).cast("long").alias("features"),
                  F.countDistinct(unit).cast("long").alias("units"))


def truth_total(df: DataFrame, col: str = TARGET) -> DataFrame:
    """A10: sum of the truth RUL column."""
    return df.agg(F.sum(col).cast("long").alias("total_rul"))


def with_risk(df: DataFrame, p: str = "predicted_rul") -> DataFrame:
    return df.withColumn("risk_level", risk_level(p))

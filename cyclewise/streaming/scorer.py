"""Streaming operators.

* ``score_stream`` (T1): a streaming DataFrame is scored by a fitted PipelineModel
  inside ``foreachBatch``; batch size is bounded by the source
  (``maxFilesPerTrigger`` / ``maxBytesPerTrigger``), ``Trigger.AvailableNow``
  drains the tail, and the true number of batches is reported.
* ``stream_features`` (T2): lag / rolling features on a stream. Window functions
  are not allowed on streams, so the last ``H`` rows of each unit are kept in state, in
  buckets of units (``applyInPandasWithState``); a row whose cycle is not after the unit's last
  seen cycle, or repeats one of its batch, is dropped and counted.
* ``stream_risk_counts`` (T3): continuous count per risk band.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from cyclewise.functions.risk import clamp_rul, risk_level
from cyclewise.operators.features import feature_names, rolling_arrays
from cyclewise.plans.scoring import complete_features
from cyclewise.schema import CYCLE, LAGS, UNIT, WINDOWS


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = 1, max_bytes: str | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    return r.load(path)


def score_stream(stream: DataFrame, model, callback: Callable[[DataFrame, int], None],
                 checkpoint: str, online: bool = False) -> int:
    """Score every micro-batch with ``model`` and hand it to ``callback(preds, batch_id)``,
    every row of it: one with incomplete features or a NaN result has a NULL prediction.
    ``online`` answers as the serving path does: ``risk_level`` bands the raw prediction, and
    the prediction itself is at least 0.
    Runs until the source is drained; returns the number of batches processed."""
    seen = []

    def each(batch: DataFrame, batch_id: int):
        out = model.transform(batch)
        p = F.when(complete_features(model, out) & ~F.isnan("prediction"), F.col("prediction"))
        out = out.withColumn("prediction", p)
        if online:
            known = F.col("prediction").isNotNull()
            out = out.withColumn("risk_level", F.when(known, risk_level("prediction"))).withColumn(
                "prediction", F.when(known, clamp_rul("prediction")))
        callback(out, batch_id)
        seen.append(batch_id)

    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return len(seen)


def write_batches_to(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: append each micro-batch (idempotent per batch id via its folder)."""
    def cb(df: DataFrame, batch_id: int):
        df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch={batch_id}")
    return cb


def rolling_mean_std(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Trailing n-row mean and sample std (NaN = missing), vectorised over rows and
    accumulated oldest-first with the same update steps as Spark's ``avg`` and
    ``stddev_samp`` (running sum; Welford m2 += d * (d - d/n)), so stream and batch
    features agree bit for bit."""
    rows = len(x)
    cnt = np.zeros(rows)
    tot = np.zeros(rows)
    mu = np.zeros(rows)
    m2 = np.zeros(rows)
    for j in range(n - 1, -1, -1):
        v = np.full(rows, np.nan)
        if j < rows:
            v[j:] = x[:rows - j]
        ok = ~np.isnan(v)
        c = cnt + ok
        tot = np.where(ok, tot + np.where(ok, v, 0.0), tot)
        delta = np.where(ok, v - mu, 0.0)
        dn = np.where(ok, delta / np.where(c == 0, 1, c), 0.0)
        mu = np.where(ok, mu + dn, mu)
        m2 = np.where(ok, m2 + delta * (delta - dn), m2)
        cnt = c
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.where(cnt > 0, tot / cnt, np.nan)
        std = np.where(cnt > 1, np.sqrt(m2 / (cnt - 1)), np.nan)
    return mean, std


BUCKETS = 256  # groups of units that share a state row: Spark's cost per group is milliseconds
_NEVER = -1 << 63
_STATE = T.StructType([T.StructField(c, T.BinaryType())
                       for c in ("units", "last", "late", "rows", "cycles", "values")])


def stream_features(stream: DataFrame, cols: list[str], lags=LAGS, windows=WINDOWS,
                    unit: str = UNIT, cycle: str = CYCLE, timeout: str | None = None,
                    dropped: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Per-unit lag / rolling features over a stream of (unit, cycle, cols...).

    Output: (unit, cycle, cols..., features...) for each accepted row, equal to the
    batch ``window_features`` on the same rows when every unit's cycles arrive in order.
    ``dropped`` names an output column with the unit's rows dropped so far, late or repeated.
    Units are kept together in ``buckets`` by a hash; with a ``timeout`` each is on its own.
    """
    lags, windows = list(lags), list(windows)
    keep = max([1] + lags + [n - 1 for n in windows])
    names = feature_names(cols, lags, windows)
    out_schema = T.StructType(
        [T.StructField(unit, T.LongType()), T.StructField(cycle, T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in cols]
        + [T.StructField(n, T.DoubleType()) for n in names]
        + ([T.StructField(dropped, T.LongType())] if dropped else []))

    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        parts = [(p["_u"].to_numpy(np.int64), p["_at"].to_numpy(np.int64), p[cols].to_numpy(np.float64))
                 for p in pdfs]
        u, at, x = (np.concatenate(c) for c in zip(*parts))
        if state.exists:
            units, last, late, held, cycles = (np.frombuffer(b, np.int64) for b in state.get[:5])
            values = np.frombuffer(state.get[5]).reshape(len(cycles), len(cols))
        else:
            units = last = late = held = cycles = np.zeros(0, np.int64)
            values = np.zeros((0, len(cols)))
        # the bucket's units, those of this batch included
        every = np.union1d(units, u)
        old = np.searchsorted(every, units)
        last_of, late_of = np.full(len(every), _NEVER), np.zeros(len(every), np.int64)
        last_of[old], late_of[old] = last, late
        order = np.lexsort((at, u))
        u, at, x = u[order], at[order], x[order]
        mine = np.searchsorted(every, u)
        ok = at > last_of[mine]
        ok[1:] &= (u[1:] != u[:-1]) | (at[1:] != at[:-1])
        late_of += np.bincount(mine[~ok], minlength=len(every))
        # rows in the order of (unit, cycle), each unit's kept ones before its new ones
        place = np.concatenate([np.repeat(old, held), mine[ok]])
        cycles, values = np.concatenate([cycles, at[ok]]), np.concatenate([values, x[ok]])
        new = np.arange(len(place)) >= len(place) - int(ok.sum())
        order = np.lexsort((cycles, place))
        place, cycles, values, new = place[order], cycles[order], values[order], new[order]
        size = np.bincount(place, minlength=len(every))
        seen = np.arange(len(place)) - (np.cumsum(size) - size)[place]
        ends = np.cumsum(size)[size > 0] - 1
        last_of[place[ends]] = cycles[ends]
        stays = size[place] - seen <= keep
        state.update(tuple(a.tobytes() for a in (
            every, last_of, late_of, np.minimum(size, keep), cycles[stays], values[stays])))
        if timeout:
            state.setTimeoutDuration(timeout)
        if not new.any():
            return
        padded = np.pad(values.T, ((0, 0), (keep, 0)), constant_values=np.nan)
        known = ~np.isnan(padded)
        feats = [np.where(seen >= k, padded[c, keep - k:keep - k + len(seen)], np.nan)
                 for c in range(len(cols)) for k in lags]
        rolled = [rolling_arrays(padded, known, seen, n) for n in windows]
        for c in range(len(cols)):
            for mean, std, count in rolled:
                feats += [np.where(count[c] > 0, mean[c], np.nan), np.where(count[c] > 1, std[c], np.nan)]
        res = pd.DataFrame(np.column_stack([values, *feats])[new], columns=[*cols, *names])
        res.insert(0, cycle, cycles[new])
        res.insert(0, unit, None if key[1] else every[place[new]])
        if dropped:
            res[dropped] = late_of[place[new]]
        yield res

    base = stream.select(F.col(unit).cast("long").alias("_u"), F.col(cycle).cast("long").alias("_at"),
                         *[F.col(c).cast("double").alias(c) for c in cols])
    bucket = F.col("_u") if timeout else F.pmod(F.xxhash64("_u"), F.lit(buckets))
    base = base.select(F.coalesce(bucket, F.lit(0)).alias("_bucket"), F.col("_u").isNull().alias("_none"),
                       F.coalesce("_u", F.lit(0)).alias("_u"), F.coalesce("_at", F.lit(_NEVER)).alias("_at"), *cols)
    to = GroupStateTimeout.ProcessingTimeTimeout if timeout else GroupStateTimeout.NoTimeout
    return base.groupBy("_bucket", "_none").applyInPandasWithState(fn, out_schema, _STATE, "append", to)


def stream_risk_counts(stream: DataFrame, p: str = "predicted_rul") -> DataFrame:
    """Running count of rows per risk band (use outputMode 'complete' or 'update')."""
    return stream.groupBy(risk_level(p).alias("risk_level")).agg(F.count(F.lit(1)).alias("n"))

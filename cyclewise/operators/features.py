"""Label and time-series features per unit: RUL, lags, rolling mean/std.

All window expressions of one call are emitted in a single ``select`` so they
share one shuffle and one sort. Long units are cut into row blocks; each block
also receives the last ``halo`` rows of the block before it, so a lag/rolling
frame never needs rows from further back. Rows are hash-partitioned by
(unit, block), which bounds a task by the block size even when one unit holds
a large share of the table.

A window expression takes a step per row of each row's frame. Rolling features of number columns
are therefore taken in arrays over the sorted blocks (NumPy on Arrow batches), with the same steps
in the same order, so that both ways agree bit for bit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.operators.position import value_bucket, with_position
from cyclewise.schema import CYCLE, LAGS, TARGET, UNIT, WINDOWS

DEFAULT_BLOCK_ROWS = 1 << 18


def add_rul(df: DataFrame, unit: str = UNIT, cycle: str = CYCLE, target: str = TARGET,
            method: str = "join", max_col: str | None = None) -> DataFrame:
    """RUL = max(cycle) of the unit - cycle.

    ``join`` (default) pre-aggregates max per unit map-side and joins it back;
    AQE broadcasts the per-unit table when its measured size allows and splits
    skewed partitions otherwise. ``window`` is the single-window form.
    ``max_col`` names a column that already holds the unit's last cycle (e.g.
    the row count from ``with_position``); it is used and dropped.
    """
    if max_col is not None:
        return df.withColumn(target, (F.col(max_col) - F.col(cycle)).cast("long")).drop(max_col)
    if method == "window":
        return df.withColumn(target, (F.max(cycle).over(Window.partitionBy(unit)) - F.col(cycle))
                             .cast("long"))
    mx = df.groupBy(unit).agg(F.max(cycle).alias("_max_cycle")).withColumnRenamed(unit, "_u")
    j = df.join(mx, df[unit].eqNullSafe(mx["_u"]), "left").drop("_u")
    return j.withColumn(target, (F.col("_max_cycle") - F.col(cycle)).cast("long")) \
        .drop("_max_cycle")


def lag_name(c: str, k: int) -> str:
    return f"{c}_lag_{k}"


def rolling_names(c: str, n: int) -> tuple[str, str]:
    return f"{c}_rolling_mean_{n}", f"{c}_rolling_std_{n}"


def feature_names(cols: list[str], lags=LAGS, windows=WINDOWS) -> list[str]:
    """Engineered column names in output order: all lags, then rolling mean/std pairs."""
    out = [lag_name(c, k) for c in cols for k in lags]
    for c in cols:
        for n in windows:
            out.extend(rolling_names(c, n))
    return out


def halo_window(df: DataFrame, build, halo: int, unit: str = UNIT, cycle: str = CYCLE,
                dense_cycles: bool = False, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Evaluate backward-looking window expressions per unit in bounded blocks.

    ``build(w, pos)`` returns the Column expressions to append, given the window
    spec ``w`` (partition (unit, block), order by row position) and the position
    column; every frame must reach at most ``halo`` rows back and none forward.
    """
    rows, pos, home = _halo_rows(df, halo, unit, cycle, dense_cycles, block_rows)
    w = Window.partitionBy(unit, "_blk").orderBy(pos)
    exprs = build(w, pos)
    out = rows.select(*df.columns, *(["_pos"] if not dense_cycles else []), "_blk", *exprs)
    out = out.filter(F.col("_blk") == home).drop("_blk")
    return out if dense_cycles else out.drop("_pos")


def _halo_rows(df: DataFrame, halo: int, unit: str, cycle: str, dense_cycles: bool, block_rows: int):
    """(rows with their blocks ``_blk``, position, home block): each row in its own block and in
    those that it is a halo of."""
    base = df
    if dense_cycles:
        pos = F.col(cycle)
    else:
        base = with_position(df, unit, [cycle], value_bucket(cycle, block_rows), out="_pos")
        pos = F.col("_pos")
    zpos = pos - F.lit(1)
    home = F.floor(zpos / F.lit(block_rows))
    # a row is also copied to every later block whose first row lies within ``halo`` rows
    # after it (one extra block when halo <= block_rows)
    last = F.floor((zpos + F.lit(halo)) / F.lit(block_rows))
    return base.withColumn("_blk", F.explode(F.sequence(home, last))), pos, home


_NUMBERS = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType)
_PLAIN = (*_NUMBERS, T.StringType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType,
          T.TimestampNTZType, T.DecimalType)


def in_arrays(df: DataFrame, cols: list[str], unit: str) -> bool:
    """Whether rolling features of ``cols`` can be taken in arrays: numbers to roll over, every
    column one that Arrow passes through, units that compare by their value."""
    kind = {f.name: f.dataType for f in df.schema.fields}
    return (all(isinstance(kind.get(c), _NUMBERS) for c in cols) and len(kind) == len(df.columns)
            and all(isinstance(t, _PLAIN) for t in kind.values())
            and isinstance(kind[unit], (*_NUMBERS[2:], T.StringType, T.DateType)))


def rolling_arrays(x: np.ndarray, ok: np.ndarray, seen: np.ndarray, n: int):
    """Trailing n-row (mean, sample std, count) of each column of ``x`` (columns, halo + rows); ``ok``
    marks known values and ``seen`` counts each row's earlier rows in its group (of at least n - 1
    in sight). Values are added oldest first with the steps of Spark's ``avg`` and ``stddev_samp``."""
    rows, halo = len(seen), x.shape[1] - len(seen)
    mean, std = np.empty((len(x), rows)), np.empty((len(x), rows))
    count = np.full((len(x), rows), n)
    short = seen < n - 1
    if not ok.all():
        missing = np.cumsum(np.pad(~ok, ((0, 0), (1, 0))), axis=1)
        short = short | (missing[:, halo + 1:] > missing[:, halo + 1 - n:-n]).any(axis=0)
    with np.errstate(all="ignore"):
        if not short.all():  # whole frames of known values
            for c, values in enumerate(x):
                total, mu, m2 = np.zeros(rows), np.zeros(rows), np.zeros(rows)
                for k in range(1, n + 1):
                    v = values[halo - n + k:halo - n + k + rows]
                    total += v
                    delta = v - mu
                    part = delta / k
                    mu += part
                    np.subtract(delta, part, out=part)
                    part *= delta
                    m2 += part
                mean[c] = total / n
                std[c] = np.sqrt(m2 / max(n - 1, 1))
        some = np.flatnonzero(short)
        if len(some):
            shape = (len(x), len(some))
            total, mu, m2, held = np.zeros(shape), np.zeros(shape), np.zeros(shape), np.zeros(shape, np.int64)
            for j in range(n - 1, -1, -1):
                at = some + halo - j
                known = ok[:, at] & (seen[some] >= j)
                v = x[:, at]
                held = held + known
                total = np.where(known, total + v, total)
                delta = v - mu
                part = delta / held
                mu = np.where(known, mu + part, mu)
                m2 = np.where(known, m2 + delta * (delta - part), m2)
            mean[:, some], std[:, some] = total / held, np.sqrt(m2 / (held - 1))
            count[:, some] = held
    return mean, std, count


def rounded(c: str | Column, decimals: int) -> Column:
    """round(c * 10^d) / 10^d in doubles, halves away from zero as in ``F.round``, which writes every
    number out in decimals to round it."""
    m = F.lit(float(10 ** decimals))
    x = (F.col(c) if isinstance(c, str) else c) * m
    whole = F.rint(x)  # halves to even
    half = F.when((x - whole == 0.5) & (x > 0), 1.0).when((x - whole == -0.5) & (x < 0), -1.0).otherwise(0.0)
    return (whole + half) / m


def rounded_array(x: np.ndarray, decimals: int) -> np.ndarray:
    """The same steps as ``rounded``."""
    m = float(10 ** decimals)
    with np.errstate(all="ignore"):
        x = x * m
        whole = np.rint(x)
        off = x - whole
        return (whole + np.where((off == 0.5) & (x > 0), 1.0, np.where((off == -0.5) & (x < 0), -1.0, 0.0))) / m


def _array_features(df: DataFrame, cols: list[str], lags: list[int], windows: list[int], halo: int,
                    unit: str, cycle: str, dense_cycles: bool, block_rows: int, decimals: int | None,
                    complete: bool) -> DataFrame:
    """``window_features`` over blocks sorted by position, in arrays; the last ``halo`` rows of an
    Arrow batch go on to the next. ``complete`` leaves out rows with any NULL or NaN."""
    rows, pos, home = _halo_rows(df, halo, unit, cycle, dense_cycles, block_rows)
    dealt = rows.withColumn("_own", F.col("_blk") == home).repartition(unit, "_blk").sortWithinPartitions(
        unit, "_blk", pos).select(*df.columns, "_blk", "_own")
    kind = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType(
        [*df.schema.fields, *[T.StructField(lag_name(c, k), kind[c] if decimals is None else T.DoubleType())
                                for c in cols for k in lags],
         *[T.StructField(m, T.DoubleType()) for c in cols for n in windows for m in rolling_names(c, n)]])

    def differs(a: pa.Array, b: pa.Array) -> np.ndarray:
        return np.asarray(pc.not_equal(a, b).fill_null(False)) | (
            np.asarray(a.is_null()) != np.asarray(b.is_null()))

    def finished(x: np.ndarray, null: np.ndarray) -> pa.Array:
        return pa.array(x if decimals is None else rounded_array(x, decimals), mask=null)

    def run(batches):
        before = None  # the last rows of the batch before, and how many of their group lie before each
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            at = np.arange(n)
            new = np.ones(n, bool)
            keys = [batch.column(c) for c in (unit, "_blk")]
            new[1:] = np.any([differs(k[1:], k[:-1]) for k in keys], axis=0)
            if before:
                new[0] = any(differs(k[:1], b)[0] for k, b in zip(keys, before[0]))
            seen = at - np.maximum.accumulate(np.where(new, at, 0))
            if before and not new[0]:
                first = int(np.argmax(new)) if new.any() else n
                seen[:first] += before[1] + 1
            values = {c: batch.column(c) if not before else pa.concat_arrays([before[2][c], batch.column(c)])
                      for c in cols}
            held = len(next(iter(values.values()))) - n
            pad = halo - held
            ok = np.array([np.pad(np.asarray(v.is_valid()), (pad, 0)) for v in values.values()])
            x = np.array([np.pad(np.asarray(v.fill_null(0)).astype(np.float64), (pad, 0)) for v in values.values()])
            out = [batch.column(c) for c in df_columns]
            if decimals is None:
                places = [pa.array(at + held - k, mask=seen < k) for k in lags]
                out += [values[c].take(p) for c in cols for p in places]
            else:
                out += [finished(x[c, halo - k:halo - k + n], (seen < k) | ~ok[c, halo - k:halo - k + n])
                        for c in range(len(cols)) for k in lags]
            stats = [rolling_arrays(x, ok, seen, w) for w in windows]
            for c in range(len(cols)):
                for mean, std, count in stats:
                    out += [finished(mean[c], count[c] < 1), finished(std[c], count[c] < 2)]
            own = np.asarray(batch.column("_own").fill_null(False))
            for v in out if complete else ():
                own = own & np.asarray(v.is_valid())
                if pa.types.is_floating(v.type):
                    own &= ~np.isnan(np.asarray(v.fill_null(0)))
            before = ([k[-1:] for k in keys], int(seen[-1]),
                      {c: v[max(0, len(v) - halo):] if halo else v[:0] for c, v in values.items()})
            done = pa.RecordBatch.from_arrays(out, names=names)
            yield done if own.all() else done.filter(pa.array(own))

    names, df_columns = schema.names, df.columns
    return dealt.mapInArrow(run, schema)


def window_features(df: DataFrame, cols: list[str], lags=LAGS, windows=WINDOWS,
                    unit: str = UNIT, cycle: str = CYCLE, dense_cycles: bool = False,
                    block_rows: int = DEFAULT_BLOCK_ROWS, decimals: int | None = None,
                    complete: bool = False) -> DataFrame:
    """Append lag and rolling features of ``cols`` (per unit, in cycle order).

    ``{c}_lag_{k}``: value k rows earlier in the unit, NULL before the start.
    ``{c}_rolling_mean_{n}`` / ``{c}_rolling_std_{n}``: mean / sample std over the
    last n rows including the current one (at least 1 row; std NULL on 1 row).

    With ``dense_cycles`` the cycle column already counts rows 1, 2, 3, ... in
    every unit; otherwise a row position is derived first (skew-safe). ``decimals`` rounds
    the features (halves away from zero), ``complete`` drops rows with any NULL or NaN.
    """
    lags, windows = list(lags), list(windows)
    halo = max([0] + lags + [n - 1 for n in windows])
    if windows and min(lags + windows) > 0 and in_arrays(df, cols, unit):
        return _array_features(df, cols, lags, windows, halo, unit, cycle, dense_cycles, block_rows,
                               decimals, complete)

    def build(w, pos):
        exprs = [F.lag(c, k).over(w).alias(lag_name(c, k)) for c in cols for k in lags]
        for c in cols:
            for n in windows:
                frame = w.rowsBetween(1 - n, 0)
                m, s = rolling_names(c, n)
                exprs += [F.avg(c).over(frame).alias(m), F.stddev_samp(c).over(frame).alias(s)]
        return exprs

    out = halo_window(df, build, halo, unit, cycle, dense_cycles, block_rows)
    if decimals is not None:
        out = out.withColumns({c: rounded(c, decimals) for c in feature_names(cols, lags, windows)})
    return drop_incomplete(out) if complete else out


def add_lags(df: DataFrame, cols: list[str], lags=LAGS, **kw) -> DataFrame:
    return window_features(df, cols, lags=lags, windows=[], **kw)


def add_rolling(df: DataFrame, cols: list[str], windows=WINDOWS, **kw) -> DataFrame:
    return window_features(df, cols, lags=[], windows=windows, **kw)


def drop_incomplete(df: DataFrame, observe: bool = False):
    """Drop rows with any NULL or NaN (P7). With ``observe`` returns (rows, Observation): after
    an action on the rows, the observation holds the ``dropped`` count of that same pass."""
    if not observe:
        return df.na.drop("any")
    obs = Observation("drop_incomplete")
    missing = F.lit(False)
    for f in df.schema.fields:
        missing = missing | F.col(f.name).isNull()
        if f.dataType.typeName() in ("float", "double"):
            missing = missing | F.isnan(f.name)
    return df.observe(obs, F.count_if(missing).alias("dropped")).na.drop("any"), obs


def build_feature_table(df: DataFrame, cols: list[str], lags=LAGS, windows=WINDOWS,
                        unit: str = UNIT, cycle: str = CYCLE, dense_cycles: bool = False,
                        block_rows: int = DEFAULT_BLOCK_ROWS, dropna: bool = True,
                        max_col: str | None = None, decimals: int | None = None) -> DataFrame:
    """RUL + lags + rolling stats, then drop incomplete rows: the training table."""
    return window_features(add_rul(df, unit, cycle, max_col=max_col), cols, lags, windows, unit,
                           cycle, dense_cycles, block_rows, decimals, complete=dropna)

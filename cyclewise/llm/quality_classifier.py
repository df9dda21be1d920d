"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

Word vectors come from random indexing over every document: each word has a sparse random
index vector (a few +1/-1 at hashed places of ``DIM``), and its context vector is the sum
of the index vectors of its neighbours at distance 1, rotated by side. Words share a table
of ``ROWS`` hashed rows, so the table has a fixed size (ROWS x DIM numbers) however large
the corpus is; tasks add up their own part of it and the parts are summed in Spark, by
slices of rows. Rows are divided by their neighbour count: frequent and rare words get
vectors of like length.

A document is pooled into mean and standard deviation over its words of context vector and
index vector, plus how often words recur, side by side and anywhere, and their number; a network with one hidden layer (NumPy) is
fitted on at most ``SAMPLE`` labelled documents, chosen by hash, and its logits are divided
by a temperature fitted on labelled documents the weights have not seen. Scores use the text
alone: never id, language, source or labels.

Defined cases: null and empty texts pool to zeros and get a score like any other; without
two label classes the score is the (smoothed) label mean; repeated rows get equal scores;
extra columns are ignored; labels of ids that are not in ``docs`` are not used.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.llm import text as X

ROWS = 1 << 13      # hashed rows of the word table
DIM = 32            # places of a word vector
NONZERO = 4         # +1/-1 entries of an index vector
SLICE = 512         # rows of the table per summed record
SAMPLE = 6000       # most labelled documents that the network is fitted on
HIDDEN = 32
EPOCHS = 60
CLIP = 5.0          # most standard deviations of a feature
_MODELS: dict[str, tuple] = {}


def _index_entries() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each row's index vector, from hashes."""
    h = X.mix64(np.arange(ROWS * NONZERO, dtype=np.uint64) + np.uint64(1))
    place = (h % np.uint64(DIM)).astype(np.int64).reshape(ROWS, NONZERO)
    sign = np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0).reshape(ROWS, NONZERO)
    return place, sign


PLACE, SIGN = _index_entries()
INDEX = np.zeros((ROWS, DIM), np.float32)
np.add.at(INDEX, (np.arange(ROWS)[:, None], PLACE), SIGN)

# a token is a run of letters/digits or a single other visible byte, so symbols stand alone
_WORDY = X.ALNUM
_MARK = X.NOT_SPACE & ~X.ALNUM


def token_rows(raw: bytes) -> np.ndarray:
    """Table row of each token of a text, in order."""
    buf = np.frombuffer(raw, np.uint8)
    s, _, h = X.words(buf, _WORDY)
    m = np.flatnonzero(_MARK[buf])
    rows = (h >> np.uint64(20)) % np.uint64(ROWS)
    if len(m):
        at = np.concatenate([s, m])
        marks = X.mix64(buf[m].astype(np.uint64) + np.uint64(7)) % np.uint64(ROWS)
        rows = np.concatenate([rows, marks])[np.argsort(at, kind="stable")]
    return rows.astype(np.int64)


def word_table(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Context vectors of all ROWS rows, summed over every document."""
    frame = docs.select(F.col(f"`{text_col}`").cast("string").alias("__text"))

    def part(batches):
        table, count = np.zeros(ROWS * DIM, np.int64), np.zeros(ROWS, np.int64)
        waiting, size = [], 0
        for batch in batches:
            for raw in X.documents(batch, "__text"):
                r = token_rows(raw)
                for at in range(0, len(r) - 1, 1 << 20):
                    piece = r[at:at + (1 << 20) + 1]
                    waiting.append(piece)
                    size += len(piece)
                    if size > 1 << 20:
                        _add_neighbours(table, count, waiting)
                        waiting, size = [], 0
        _add_neighbours(table, count, waiting)
        for at in range(0, ROWS, SLICE):
            n = count[at:at + SLICE]
            if n.any():
                block = table[at * DIM:(at + SLICE) * DIM]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // SLICE], pa.int32()), pa.array([block.tobytes()], pa.binary()),
                     pa.array([n.tobytes()], pa.binary())], names=["slice", "part", "n"])

    schema = "slice int, part binary, n binary"
    # two steps, so that a task adds up the square root of the number of parts at most
    salts = max(1, math.isqrt(frame.rdd.getNumPartitions()))
    parts = frame.mapInArrow(part, schema).withColumn(
        "salt", F.pmod(F.xxhash64("part", "n"), F.lit(salts)))
    sums = (parts.groupBy("slice", "salt").applyInPandas(_sum_parts, schema)
            .groupBy("slice").applyInPandas(_sum_parts, schema))
    table, counts = np.zeros((ROWS, DIM)), np.zeros(ROWS, np.int64)
    for row in sums.collect():  # ROWS x DIM numbers, whatever the corpus
        at = row.slice * SLICE
        table[at:at + SLICE] = np.frombuffer(row.part, np.int64).reshape(SLICE, DIM)
        counts[at:at + SLICE] = np.frombuffer(row.n, np.int64)
    return (table / np.maximum(counts, 1)[:, None]).astype(np.float32)


def _sum_parts(pdf: pd.DataFrame) -> pd.DataFrame:
    total, n = np.zeros(SLICE * DIM, np.int64), np.zeros(SLICE, np.int64)
    for p, c in zip(pdf["part"], pdf["n"]):
        total += np.frombuffer(p, np.int64)
        n += np.frombuffer(c, np.int64)
    return pd.DataFrame({"slice": [pdf["slice"].iloc[0]], "part": [total.tobytes()],
                         "n": [n.tobytes()]})


def _add_neighbours(table: np.ndarray, count: np.ndarray, texts: list[np.ndarray]) -> None:
    """Adds to each token's row the index vectors of its neighbours, right ones rotated."""
    if not texts:
        return
    left = np.concatenate([r[:-1] for r in texts])
    right = np.concatenate([r[1:] for r in texts])
    for own, other, turn in ((left, right, 0), (right, left, 1)):
        for k in range(NONZERO):
            cell = own * DIM + (PLACE[other, k] + turn) % DIM
            table += np.bincount(cell, SIGN[other, k], ROWS * DIM).astype(np.int64)
        count += np.bincount(own, minlength=ROWS)


def pool(raw: bytes, table: np.ndarray) -> np.ndarray:
    """Pooled features of a text: mean and spread of its words' vectors, vocabulary spread."""
    r = token_rows(raw)
    out = np.zeros(FEATURES, np.float32)
    if not len(r):
        return out
    rows, n = np.unique(r, return_counts=True)
    p = (n / len(r)).astype(np.float32)
    both = np.concatenate([table[rows], INDEX[rows]], axis=1)
    mean = p @ both
    out[:2 * DIM] = mean
    out[2 * DIM:4 * DIM] = np.sqrt(np.maximum(p @ (both * both) - mean * mean, 0))
    if len(r) > 1:  # near 1 for one word over and over, whatever the length
        out[4 * DIM] = float((n * (n - 1)).sum() / (len(r) * (len(r) - 1)))
        out[4 * DIM + 1] = float((r[1:] == r[:-1]).mean())
    out[4 * DIM + 2] = np.log1p(len(r)) / 10
    return out


FEATURES = 4 * DIM + 3


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 5) -> dict:
    """Two-layer network by Adam on the log loss; temperature by search on held-out rows."""
    rng = np.random.default_rng(seed)
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    prior = (y.sum() + 1.0) / (len(y) + 2.0)
    model = {"mean": mean, "scale": scale, "prior": float(prior), "temperature": 1.0}
    if len(np.unique(y)) < 2 or len(y) < 20:
        return model | {"w1": None}
    z = np.clip((x - mean) / scale, -CLIP, CLIP)
    order = rng.permutation(len(y))
    held, train = order[:len(y) // 5], order[len(y) // 5:]
    w = {"w1": rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)), "b1": np.zeros(HIDDEN),
         "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(1)}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(train), max(1, len(train) // 128)):
            step += 1
            h = np.maximum(z[part] @ w["w1"] + w["b1"], 0)
            g = (1 / (1 + np.exp(-(h @ w["w2"] + w["b2"]))) - y[part]) / len(part)
            gh = np.outer(g, w["w2"]) * (h > 0)
            grad = {"w1": z[part].T @ gh + 1e-4 * w["w1"], "b1": gh.sum(0),
                    "w2": h.T @ g + 1e-4 * w["w2"], "b2": np.array([g.sum()])}
            for k in w:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                w[k] = w[k] - 0.003 * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    logit = np.maximum(z[held] @ w["w1"] + w["b1"], 0) @ w["w2"] + w["b2"]
    if len(held):
        def loss(t):
            v = logit / t
            return float(np.mean(np.logaddexp(0, v) - y[held] * v))
        model["temperature"] = min(np.exp(np.linspace(np.log(0.25), np.log(8), 61)), key=loss)
    return model | w


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """Calibrated probability of label 1."""
    if model["w1"] is None:
        return np.full(len(x), model["prior"])
    z = np.clip((x - model["mean"]) / model["scale"], -CLIP, CLIP)
    h = np.maximum(z @ model["w1"] + model["b1"], 0)
    v = np.clip((h @ model["w2"] + model["b2"]) / model["temperature"], -40, 40)
    return 1 / (1 + np.exp(-v))


def learnable(id_col: Column) -> Column:
    """Rows whose labels may be learned: crc32 of the id as text, mod 3, is not 1."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")),
                  F.lit(3)) != 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, dict]:
    """(word table, network). Word statistics from all of ``docs``, labels from ``labels``."""
    table = word_table(docs, text_col)
    usable = labels.where(learnable(F.col(f"`{id_col}`")) & F.col(f"`{label_col}`").isNotNull()
                          & F.col(f"`{id_col}`").isNotNull())
    chosen = (usable.groupBy(F.col(f"`{id_col}`").alias("__label_id"))
              .agg(F.max(F.col(f"`{label_col}`")).cast("double").alias("__y"))
              .orderBy(F.xxhash64(F.col("__label_id").cast("string")), "__label_id").limit(sample))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    found = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string")
                        .alias("__text")).join(F.broadcast(chosen),  # ``sample`` rows at most
                                               F.col("__id") == F.col("__label_id"))
    schema = T.StructType([T.StructField("__id", found.schema["__id"].dataType),
                           T.StructField("__y", T.DoubleType()),
                           T.StructField("x", T.BinaryType())])

    def run(batches):
        for batch in batches:
            x = [pool(raw, shared.value).tobytes() for raw in X.documents(batch, "__text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                              pa.array(x, pa.binary())], names=schema.names)

    pooled = found.select("__id", "__y", "__text").mapInArrow(run, schema)
    # one row per labelled id (a repeated id keeps its least vector): ``sample`` rows at most
    rows = pooled.groupBy("__id").agg(F.min("x").alias("x"), F.min("__y").alias("y")).collect()
    rows.sort(key=lambda r: (bytes(r.x), r.y))
    x = np.array([np.frombuffer(r.x, np.float32) for r in rows], np.float64).reshape(-1, FEATURES)
    return table, fit_network(x, np.array([r.y for r in rows]))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", sample: int = SAMPLE,
             keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` plus score (probability of label 1) and predicted."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    table, model = fit(docs, labels, id_col, text_col, label_col, sample)
    shared = docs.sparkSession.sparkContext.broadcast((table, model))
    name = uuid.uuid4().hex

    @F.arrow_udf(T.DoubleType())
    def scored(column: pa.Array) -> pa.Array:
        if name not in _MODELS:
            _MODELS.clear()
            _MODELS[name] = shared.value
        table, model = _MODELS[name]
        batch = pa.RecordBatch.from_arrays([column], names=["t"])
        x = [pool(raw, table) for raw in X.documents(batch, "t")]
        return pa.array(score(model, np.array(x, np.float64).reshape(-1, FEATURES)), pa.float64())

    out = docs.select(*[F.col(f"`{c}`") for c in keep],
                      scored(F.col(f"`{text_col}`").cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

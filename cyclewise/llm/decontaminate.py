"""Benchmark decontamination with one Aho-Corasick automaton over test-item windows.

Words are the runs of digits, letters and non-ASCII characters of the text with A-Z
lower-cased. An item gives a window of ``window`` consecutive words at each position
(an item with fewer words gives one window of all of them). The windows of all items form
one automaton whose alphabet is the items' vocabulary, so a document's words are scanned
once; a word outside the vocabulary resets it. Hit words map back to character offsets of
the original text.

The items are the only thing sent to the tasks. Their size is measured first and split
into parts of at most ``part_bytes`` of text, one automaton each; with more than one part
the documents pass through one scan per part, which merges its hits into those so far.

Defined cases: null or empty texts have no words and no hits; an item without words never
occurs; items that share an id count as one item; an item's null id reads ``null``;
repeated documents each get their row; extra columns are kept or dropped as asked by
``keep`` and never read; an empty item table leaves every document clean.
"""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.llm import text as X

WINDOW = 10
PART_BYTES = 2_000_000

_NORMAL = bytes(X.LOWER[i] if X.ALNUM[i] else 0x20 for i in range(256))
_AUTOMATA: dict[str, tuple] = {}

RESULT = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("n_items", T.LongType()),
          ("item_ids", T.ArrayType(T.StringType())),
          ("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                              T.StructField("end", T.LongType())])))]


def tokens(raw: bytes) -> list[bytes]:
    """Normalised words of a text."""
    return raw.translate(_NORMAL).split()


def build(items: list[tuple[str, str]], window: int = WINDOW):
    """(vocabulary, automaton, item ids); the automaton is None when no item has words."""
    vocab: dict[bytes, int] = {}
    patterns: dict[tuple, set[int]] = {}
    ids = sorted({i for i, _ in items})
    rank = {i: k for k, i in enumerate(ids)}
    for item, raw in items:
        seq = tuple(vocab.setdefault(w, len(vocab) + 1) for w in tokens(raw.encode()))
        for at in range(max(1, len(seq) - window + 1)) if seq else ():
            patterns.setdefault(seq[at:at + window], set()).add(rank[item])
    if not patterns:
        return vocab, None, ids
    auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for seq, owners in patterns.items():
        auto.add_word(seq, (len(seq), tuple(sorted(owners))))
    auto.make_automaton()
    return vocab, auto, ids


def scan(raw: bytes, built) -> tuple[int, np.ndarray, set[str]]:
    """Number of words, indices of the hit words, ids of the occurring items."""
    vocab, auto, ids = built
    found = tokens(raw)
    if auto is None or not found:
        return len(found), np.empty(0, np.int64), set()
    get, edge, owners = vocab.get, None, set()
    for last, (size, who) in auto.iter(tuple([get(w, 0) for w in found])):
        if edge is None:
            edge = np.zeros(len(found) + 1, np.int64)
        edge[last + 1 - size] += 1
        edge[last + 1] -= 1
        owners.update(who)
    if edge is None:
        return len(found), np.empty(0, np.int64), set()
    return len(found), np.flatnonzero(np.cumsum(edge[:-1]) > 0), {ids[k] for k in owners}


def _spans(raw: bytes, hit: np.ndarray) -> list[dict]:
    """Character spans, in the original text, of the runs of hit words."""
    buf = np.frombuffer(raw, np.uint8)
    starts, ends, _ = X.words(buf, X.ALNUM, hashes=False)
    cut = np.flatnonzero(np.diff(hit) > 1)
    a = starts[hit[np.concatenate([[0], cut + 1])]]
    b = ends[hit[np.concatenate([cut, [len(hit) - 1]])]]
    return [{"start": s, "end": e}
            for s, e in zip(X.code_points(buf, a).tolist(), X.code_points(buf, b).tolist())]


def _merge(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for x in sorted(spans, key=lambda x: (x["start"], x["end"])):
        if out and x["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], x["end"])
        else:
            out.append(dict(x))
    return out


def parts_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
             part_bytes: int = PART_BYTES) -> list[list[tuple[str, str]]]:
    """The items, split by hash into lists of about ``part_bytes`` of text at most."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("t")).distinct()
    size = rows.agg(F.sum(F.octet_length("t") + F.octet_length("i"))).first()[0] or 0
    n = -(-size // part_bytes) or 1
    part = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    return [[(r.i, r.t) for r in rows.where(part == k).collect()] for k in range(n)]


def scan_benchmark(docs: DataFrame, items: DataFrame, text_col: str = "text",
                   keep: list[str] | None = None, item_id: str = "item_id",
                   item_text: str = "text", window: int = WINDOW,
                   part_bytes: int = PART_BYTES) -> DataFrame:
    """``keep`` columns of ``docs`` plus n_words, n_hit, n_items, item_ids, spans.

    n_hit counts document words inside any occurrence of a window, item_ids lists the
    items with occurring windows in string order, spans are merged character spans."""
    keep = [c for c in (docs.columns if keep is None else keep)
            if c not in {n for n, _ in RESULT}]
    out, spark = None, docs.sparkSession
    carried = keep if text_col in keep else [*keep, text_col]
    frame = docs.select(*[F.col(f"`{c}`") for c in carried])
    schema = T.StructType([*frame.schema.fields, *[T.StructField(n, t) for n, t in RESULT]])
    for part in parts_of(items, item_id, item_text, part_bytes):
        shared, name, first = spark.sparkContext.broadcast(part), uuid.uuid4().hex, out is None

        def run(batches, shared=shared, name=name, first=first):
            if name not in _AUTOMATA:
                _AUTOMATA.clear()
                _AUTOMATA[name] = build(shared.value, window)
            for batch in batches:
                yield _scan_batch(batch, _AUTOMATA[name], text_col, first)

        out = (frame if first else out).mapInArrow(run, schema)
    return out.select(*[F.col(f"`{c}`") for c in keep], *[n for n, _ in RESULT])


def _scan_batch(batch: pa.RecordBatch, built, text_col: str, first: bool) -> pa.RecordBatch:
    cols = {n: [] for n, _ in RESULT}
    earlier = None if first else [batch.column(n).to_pylist() for n in ("item_ids", "spans")]
    for k, raw in enumerate(X.documents(batch, text_col)):
        n, hit, owners = scan(raw, built)
        spans = _spans(raw, hit) if len(hit) else []
        n_hit = len(hit)
        if earlier and earlier[1][k]:
            owners |= set(earlier[0][k])
            spans = _merge([*earlier[1][k], *spans])
            n_hit = _covered(raw, spans)
        for c, v in zip(cols, (n, n_hit, len(owners), sorted(owners), spans)):
            cols[c].append(v)
    types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()),
             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    base = [c for c in batch.schema.names if c not in cols]
    return pa.RecordBatch.from_arrays(
        [batch.column(c) for c in base] + [pa.array(v, t) for v, t in zip(cols.values(), types)],
        names=[*base, *cols])


def _covered(raw: bytes, spans: list[dict]) -> int:
    """Words that lie inside the spans."""
    buf = np.frombuffer(raw, np.uint8)
    starts, _, _ = X.words(buf, X.ALNUM, hashes=False)
    at = X.code_points(buf, starts)
    return sum(int(((at >= x["start"]) & (at < x["end"])).sum()) for x in spans)

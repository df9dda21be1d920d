"""Periodic runs of words, found with an enhanced suffix array (suffix array, inverse, LCP).

A run is a stretch of words with smallest period q, at least ``max(MIN_WORDS, MIN_TIMES * q)``
words long, that no neighbouring word extends. At its right end stands a branching tandem: a
square ww with |w| = q whose two halves begin suffixes with a common prefix of exactly q words.
Such a pair of suffixes lies in one LCP interval of depth q, in two of its children. So for
every interval the children are joined one at a time, and each suffix i of the smaller side asks
whether i + q or i - q has its place (by the inverse suffix array) on the other side. That is
O(n log n) questions and no tree node is ever built. The square is then rotated to the left as
far as it goes, which gives the run; squares of one run at multiples of its period share its
ends, and the least period stays.

Several documents are handled at once, up to ``CHUNK`` words: their words get numbers of their
own per document, so that no common prefix leaves a document. Ranks of 1, 2, 4, ... words
(prefix doubling) give the suffix array, the LCP values and the rotations, all by exact
comparison. Documents in which no window of five words occurs twice cannot hold a run and are
left out.

Memory of a task: one Arrow batch, and per word of a chunk or of the longest document about 40
bytes plus 4 for each doubling of its longest repeat.

Defined cases: a null or empty text has no words and no runs; ties for the longest run go to the
smallest start, then period; repeated documents each get their row; extra columns are ignored;
an empty table gives no rows. ``tails`` rewrites texts by the test rule given there; a null id
leaves the text as it is.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.llm import text as X

MIN_WORDS, MIN_TIMES = 6, 4
CHUNK = 1 << 18  # words of short documents handled at once
STEP = 1 << 21  # suffixes asked at once
_WINDOW = 5  # every run holds such a window twice


def _levels(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of the 1, 2, 4, ... words at each place, up to the first without equal ranks."""
    rank, out, width, n = ids.astype(np.int32), [], 1, len(ids)
    while True:
        out.append(rank)
        if int(rank.max()) == n - 1:
            return out
        key = (rank.astype(np.int64) + 1) * (n + 1)
        key[:n - width] += rank[width:].astype(np.int64) + 1
        rank = np.unique(key, return_inverse=True)[1].astype(np.int32)
        width *= 2


def _equal_ahead(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal words from places a < b on."""
    n, at = len(levels[0]), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + at, b + at
        inside = np.maximum(x, y) < n
        same = np.zeros(len(a), bool)
        same[inside] = levels[k][x[inside]] == levels[k][y[inside]]
        at[same] += 1 << k
    return at


def _equal_behind(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal words that end just before places a < b."""
    at = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x = a - at - (1 << k)
        y = b - at - (1 << k)
        inside = x >= 0
        same = np.zeros(len(a), bool)
        same[inside] = levels[k][x[inside]] == levels[k][y[inside]]
        at[same] += 1 << k
    return at


def _smaller_before(lcp: np.ndarray) -> np.ndarray:
    """For each place the last one before it whose value is at most as large (place 0 is 0)."""
    found = np.maximum(np.arange(len(lcp)) - 1, 0)
    todo = np.flatnonzero(lcp[found] > lcp)
    while len(todo):
        found[todo] = found[found[todo]]
        todo = todo[lcp[found[todo]] > lcp[todo]]
    return found


def _smaller_after(lcp: np.ndarray) -> np.ndarray:
    """For each place the first one after it whose value is smaller (the length if none is)."""
    n = len(lcp)
    value = np.append(lcp, -1)
    found = np.arange(1, n + 2)
    found[n] = n
    todo = np.flatnonzero(value[found[:n]] >= lcp)
    while len(todo):
        found[todo] = found[found[todo]]
        todo = todo[value[found[todo]] >= lcp[todo]]
    return found[:n]


def _tandems(levels: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, depth) of branching tandems: equal ranks of two children, depth words apart."""
    isa = levels[-1].astype(np.int64)
    n = len(isa)
    sa = np.empty(n, np.int64)
    sa[isa] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    lcp[1:] = _equal_ahead(levels, sa[:-1], sa[1:])
    before, after = _smaller_before(lcp), _smaller_after(lcp)
    cut = np.flatnonzero(lcp > 0)
    lo, hi = before[cut], after[cut]  # the joined children are [lo, cut) and [cut, hi)
    left = cut - lo <= hi - cut
    first, size = np.where(left, lo, cut), np.where(left, cut - lo, hi - cut)
    other_lo, other_hi = np.where(left, cut, lo), np.where(left, hi, cut)
    ends = np.cumsum(size)
    at = 0
    while at < len(cut):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, "right")))
        part = slice(at, to)
        m = size[part]
        k = np.repeat(np.arange(at, to), m)
        inside = np.arange(len(k)) - np.repeat(np.cumsum(m) - m, m)
        i, depth = sa[first[k] + inside], lcp[cut[k]]
        for j in (i + depth, i - depth):
            ok = (j >= 0) & (j < n)
            place = isa[j[ok]]
            ok[ok] = (place >= other_lo[k[ok]]) & (place < other_hi[k[ok]])
            yield np.minimum(i[ok], j[ok]), depth[ok]
        at = to


def runs_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of a sequence of dense word numbers, by start, period."""
    if len(ids) < MIN_WORDS:
        none = np.empty(0, np.int64)
        return none, none, none
    levels, parts = _levels(ids), []
    for i, q in _tandems(levels):
        back = _equal_behind(levels, i, i + q)
        length = back + 2 * q
        long = length >= np.maximum(MIN_WORDS, MIN_TIMES * q)
        parts.append(np.stack([(i - back)[long], length[long], q[long]]))
    s, m, q = np.concatenate(parts, axis=1) if parts else np.empty((3, 0), np.int64)
    order = np.lexsort((q, m, s))
    s, m, q = s[order], m[order], q[order]
    if len(s):  # of periods of one stretch the least
        new = np.append(True, (s[1:] != s[:-1]) | (m[1:] != m[:-1]))
        s, m, q = s[new], m[new], q[new]
    order = np.lexsort((q, s))
    return s[order], m[order], q[order]


def test_tail(words: list[bytes], doc_id) -> list[bytes]:
    """The test rule: with h = crc32 of the decimal id, a tenth of the documents (h % 10 = 0) repeat
    words a to a + p - 1 from word a on, a = g % n, p = 1 + (n - a) // (3 + g % 8), g = h // 10."""
    n = len(words)
    if doc_id is None or not n:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def _numbers(words: list[bytes]) -> list[int]:
    seen: dict[bytes, int] = {}
    return [seen.setdefault(w, len(seen)) for w in words]


def _repeats(ids: list[int]) -> bool:
    """Whether a window of five words occurs twice."""
    n = len(ids) - _WINDOW + 1
    return n > 1 and len(set(zip(*[ids[k:] for k in range(_WINDOW)]))) < n


def runs_of_each(docs: list[list[bytes]]) -> list[np.ndarray]:
    """For each list of words its runs, rows (start, length, period) by start, then period."""
    out = [np.empty((0, 3), np.int64)] * len(docs)
    chunk: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush():
        starts = np.cumsum([0, *[len(x) for _, x in chunk]])
        base = np.cumsum([0, *[int(x.max()) + 1 for _, x in chunk]])
        s, m, q = runs_of(np.concatenate([x + b for (_, x), b in zip(chunk, base)]))
        edges = np.searchsorted(s, starts)
        for (k, _), at, lo, hi in zip(chunk, starts, edges[:-1], edges[1:]):
            out[k] = np.stack([s[lo:hi] - at, m[lo:hi], q[lo:hi]], axis=1)
        chunk.clear()

    for k, words in enumerate(docs):
        if len(words) < MIN_WORDS:
            continue
        ids = _numbers(words)
        if not _repeats(ids):
            continue
        if chunk and held + len(ids) > CHUNK:
            flush()
            held = 0
        chunk.append((k, np.array(ids, np.int64)))
        held += len(ids)
    if chunk:
        flush()
    return out


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by a space, without those that a run holds after its first period."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


def _row(words: list[bytes], runs: np.ndarray, with_text: bool) -> tuple:
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs.tolist())
    best = (None,) * 4
    if len(runs):
        s, m, q = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
        best = (s, m, q, 1000 * m // q)
    text = collapse(words, runs)
    last = ([{"start": s, "length": m, "period": q} for s, m, q in runs.tolist()], text.decode())
    return (len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(text).hexdigest(), *(last if with_text else ()))


_LONGS = ["n_runs", "start", "length", "period", "exponent_milli"]
_HASHES = ["runs_sha256", "collapsed_sha256"]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              tails: bool = False, with_text: bool = True) -> DataFrame:
    """One row per document: id, n_runs, the longest run (start, length, period, exponent_milli),
    runs_sha256, collapsed_sha256 and, ``with_text``, all runs and the collapsed text."""
    frame = X.pick(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    extra = [T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())]
    schema = T.StructType([T.StructField(id_col, frame.schema["id"].dataType),
                           *[T.StructField(n, T.LongType()) for n in _LONGS],
                           *[T.StructField(n, T.StringType()) for n in _HASHES],
                           *(extra if with_text else [])])
    arrow_run = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    types = [*[pa.int64()] * len(_LONGS), *[pa.string()] * len(_HASHES),
             *([arrow_run, pa.string()] if with_text else [])]

    def scan(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist() if tails else [None] * batch.num_rows
            for at, docs_words in _groups(batch):
                if tails:
                    docs_words = [test_tail(w, i) for w, i in zip(docs_words, ids[at:])]
                rows = [_row(w, r, with_text) for w, r in zip(docs_words, runs_of_each(docs_words))]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(rows)),
                     *[pa.array(c, t) for c, t in zip(cols, types)]], names=schema.names)

    return frame.mapInArrow(scan, schema)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]]]]:
    """First row and words of consecutive documents of a batch, about CHUNK words at a time."""
    held, group, at = 0, [], 0
    for k, raw in enumerate(X.documents(batch, "text")):
        group.append(raw.split())  # splits at \x20 and \x09-\x0D alone
        held += len(group[-1])
        if held >= CHUNK:
            yield at, group
            held, group, at = 0, [], k + 1
    if group:
        yield at, group

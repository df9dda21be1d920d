"""Vectorised byte-level text helpers shared by the training-data operators.

All of them work on the UTF-8 bytes of a batch of documents (one NumPy buffer plus
offsets), so a task's memory is one Arrow batch plus a few arrays over one segment of
about ``SEGMENT`` bytes, whatever the length of a document. A single word longer than that
is one segment, whose bytes are held a few times over; its hash is taken by pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = 1 << 20  # bytes tokenised at a time
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

# byte classes: space is [\x20\x09-\x0D]; alnum is 0-9, A-Z, a-z and every non-ASCII byte
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def pick(docs: DataFrame, **named: str) -> DataFrame:
    """Columns of ``docs`` under new names (new=old). Old names are matched as written, so other
    columns, also ones that differ in case alone, cannot clash with them."""
    plain = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    return plain.select(*[F.col(f"_{docs.columns.index(old)}").alias(new)
                          for new, old in named.items()])


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift-multiply), vectorised."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    out[1:] = base
    return np.multiply.accumulate(out)


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text. No copy without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_string(column.type) or pa.types.is_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n, at = len(column), column.offset
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[at:at + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def documents(batch: pa.RecordBatch, column: str) -> Iterator[bytes]:
    """The UTF-8 bytes of each row, a null as empty."""
    buf, off = as_bytes(batch.column(column))
    view = memoryview(buf)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        yield bytes(view[a:b])


def spans_of(buf: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes for which ``member`` (256 booleans) holds: starts, ends."""
    m = np.zeros(len(buf) + 2, np.int8)
    m[1:-1] = member[buf]
    d = np.diff(m)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def _segments(buf: np.ndarray, member: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of a document of about SEGMENT bytes, each after a byte outside any word."""
    at, n = 0, len(buf)
    while at < n:
        end = min(n, at + SEGMENT)
        while end < n and member[buf[end - 1]]:
            step = np.flatnonzero(~member[buf[end:end + SEGMENT]])
            end = min(n, end + (int(step[0]) + 1 if len(step) else SEGMENT))
        yield at, end
        at = end


def words(buf: np.ndarray, member: np.ndarray, lower: bool = False,
          hashes: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of one document: byte starts, byte ends and 64-bit hashes of their bytes."""
    parts = []
    for a, b in _segments(buf, member):
        seg = LOWER[buf[a:b]] if lower else buf[a:b]
        s, e = spans_of(seg, member)
        parts.append((s + a, e + a, span_hashes(seg, s, e) if hashes else s[:0].view(np.uint64)))
    if not parts:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64)
    return tuple(np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts))


_POW = powers(_BASE, 4096)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each [start, end) of ``buf``, modulo 2**64 and finalised."""
    global _POW
    if not len(starts):
        return np.empty(0, np.uint64)
    n = ends - starts
    if n.max() > SEGMENT:  # spans without end are hashed by pieces
        long = np.flatnonzero(n > SEGMENT)
        out = np.empty(len(n), np.uint64)
        rest = np.ones(len(n), bool)
        rest[long] = False
        out[rest] = span_hashes(buf, starts[rest], ends[rest])
        out[long] = [_long_hash(buf[starts[k]:ends[k]]) for k in long.tolist()]
        return out
    first = np.cumsum(n) - n
    inside = np.arange(int(n.sum())) - np.repeat(first, n)
    top = int(n.max())
    if top > len(_POW) and top <= 1 << 16:
        _POW = powers(_BASE, 1 << 16)
    pw = _POW if top <= len(_POW) else powers(_BASE, top)
    v = (buf[inside + np.repeat(starts, n)].astype(np.uint64) + np.uint64(1)) * pw[inside]
    return mix64(np.add.reduceat(v, first) + n.astype(np.uint64) * _M1)


def _long_hash(span: np.ndarray) -> np.uint64:
    """The hash of one span, with memory for a piece of it."""
    pw, total, mask = powers(_BASE, 1 << 16), 0, (1 << 64) - 1
    for at in range(0, len(span), len(pw)):
        piece = span[at:at + len(pw)].astype(np.uint64) + np.uint64(1)
        total += int((piece * pw[:len(piece)]).sum(dtype=np.uint64)) * pow(int(_BASE), at, 1 << 64)
    return mix64(np.array([(total & mask)], np.uint64) + np.uint64(len(span)) * _M1)[0]


def ngram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive words given the words' hashes (empty with fewer words)."""
    if len(h) < k:
        return np.empty(0, np.uint64)
    pw = powers(_M2, k + 1)
    out = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        out += h[i:len(h) - k + 1 + i] * pw[i + 1]
    return mix64(out)


def code_points(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code-point offsets of byte offsets ``at`` (whole characters) of one document, with memory
    for its non-ASCII bytes alone."""
    return at - np.searchsorted(np.flatnonzero((buf & 0xC0) == 0x80), at)


@F.arrow_udf(T.LongType())
def word_count(text: pa.Array) -> pa.Array:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    buf, off = as_bytes(text)
    out = np.zeros(len(off) - 1, np.int64)
    view = NOT_SPACE
    for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        total = 0
        for s, e in _segments(buf[a:b], view):
            total += len(spans_of(buf[a + s:a + e], view)[0])
        out[i] = total
    return pa.array(out, pa.int64())

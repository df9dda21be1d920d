"""Exact removal of repeated byte strings by a sparse, hash-compared suffix sort.

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else in
the corpus. Positions are thinned without losing a string: each window of ``length`` bytes
belongs to the place where the hash of its ``GRAM``-byte pieces is least (equal windows
agree on that place), and consecutive windows with one place form a *stretch*: the bytes
from the first window's start to the last one's end, about 1.2 % of all positions.

1. Tasks emit (place hash, digest of the stretch, document, offsets), and a partial
   aggregate finds the place hashes that occur more than once; the other rows go.
2. Where all stretches of a place hash have one digest, every one of them repeats as a
   whole. This settles copies, however many, without comparing them.
3. Places with different digests (the edges of repeated passages) keep one stretch per
   digest. Their texts are fetched and the suffixes that start at the places are sorted by
   a merge sort whose comparisons are hash-based: prefix polynomial hashes and a binary
   search give the common extension of two suffixes, so a comparison costs a logarithm of
   the length. The reversed prefixes are sorted alike. Neighbouring extensions are then
   verified byte by byte, and a window repeats if, for its offset, another stretch shares
   both its left and its right extension.
4. A place hash with more than ``HOT`` different stretches is dealt out by the digest of
   each of its windows instead, a partial aggregate, so it is never one task's work.

Covered ranges go back to their documents, which are cut once.

Defined cases: null and empty texts have no bytes; texts shorter than ``length`` lose
nothing; equal texts of at least ``length`` bytes lose all bytes, also under equal ids;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.llm import text as X
from cyclewise.session import reliable_checkpoint

LENGTH = 200
GRAM = 32
CHUNK = 1 << 20   # windows whose places are chosen at a time
BROADCAST_KEYS = 1_000_000  # most 12-byte document keys that are broadcast
HOT = 20_000      # different stretches of a place hash that one task sorts at most
PACK = 15         # bits of a stretch's size and place: length is at most 1 << 14
_B = np.uint64(0xD6E8FEB86659FD93)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))


def _rolling(buf: np.ndarray, k: int) -> np.ndarray:
    """Finalised polynomial hashes of all k-byte pieces."""
    pw = X.powers(_B, len(buf) + 1)
    pre = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * pw[:len(buf)], out=pre[1:])
    inv = X.powers(_B_INV, len(buf) + 1)
    return X.mix64((pre[k:] - pre[:-k]) * inv[:len(buf) - k + 1])


def _window_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values (block prefix and suffix minima)."""
    n = len(v) - w + 1
    pad = -len(v) % w
    blocks = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(left[:n], right[w - 1:w - 1 + n])


def stretches(buf: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Stretches of one document: arrays (place hash, start, end, place), in order.

    Windows are taken CHUNK at a time; a stretch does not run across a chunk's edge, which
    leaves equal windows the same place."""
    n = len(buf) - length + 1
    out = []
    for at in range(0, max(n, 0), CHUNK):
        size = min(CHUNK, n - at)
        piece = buf[at:at + size + length - 1]
        h = _rolling(piece, gram)
        low = np.uint64((1 << 21) - 1)
        # the hash's high bits, then the position: ties go to the leftmost
        least = _window_min((h & ~low) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
        place = (least & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], size) - 1
        out.append((h[place[first]].view(np.int64), first + at, last + length + at,
                    place[first] + at))
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*out))


def _digest(b: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "little", signed=True)


def _emit(frame: DataFrame, length: int, gram: int) -> DataFrame:
    """Stretch rows: h (place hash), d (digest), __k1, __k2 (document) and at, which packs
    the stretch's start, size and place (its offset in the stretch)."""
    schema = "h long, d long, __k1 long, __k2 int, at long"

    def run(batches):
        for batch in batches:
            k1 = batch.column("__k1").to_numpy(zero_copy_only=False)
            k2 = batch.column("__k2").to_numpy(zero_copy_only=False)
            rows, held = [], 0
            for i, raw in enumerate(X.documents(batch, "__text")):
                if len(raw) < length:
                    continue
                h, s, e, p = stretches(np.frombuffer(raw, np.uint8), length, gram)
                d = np.fromiter((_digest(raw[a:b]) for a, b in zip(s.tolist(), e.tolist())),
                                np.int64, len(s))
                at = (s << (2 * PACK)) | ((e - s) << PACK) | (p - s)
                rows.append((h, d, np.full(len(s), k1[i]), np.full(len(s), k2[i]), at))
                held += len(s)
                if held > 100_000:
                    yield _rows(rows)
                    rows, held = [], 0
            if rows:
                yield _rows(rows)

    return frame.select("__k1", "__k2", "__text").mapInArrow(run, schema)


def _rows(rows) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c), t) for c, t in zip(zip(*rows), kinds)],
        names=["h", "d", "__k1", "__k2", "at"])


# ---- hash-compared suffix sort ---------------------------------------------------------


class Suffixes:
    """Suffixes of one byte buffer, each with a start and a length, comparable by hashes."""

    def __init__(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.buf, self.start, self.size = buf, start.astype(np.int64), size.astype(np.int64)
        pw = X.powers(_B, len(buf) + 1)
        self.pre = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * pw[:len(buf)], out=self.pre[1:])
        self.inv = X.powers(_B_INV, len(buf) + 1)

    def _hash(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.pre[at + n] - self.pre[at]) * self.inv[at]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of suffixes i and j, by binary search over prefix hashes."""
        a, b = self.start[i], self.start[j]
        lo, hi = np.zeros(len(i), np.int64), np.minimum(self.size[i], self.size[j])
        for _ in range(int(hi.max(initial=0)).bit_length()):
            mid = (lo + hi + 1) >> 1
            same = self._hash(a, mid) == self._hash(b, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix i stands before suffix j (a prefix stands first; ties by number)."""
        n = self.common(i, j)
        top = len(self.buf) - 1
        x = np.where(n < self.size[i], self.buf[np.minimum(self.start[i] + n, top)].astype(int), -1)
        y = np.where(n < self.size[j], self.buf[np.minimum(self.start[j] + n, top)].astype(int), -1)
        return (x < y) | ((x == y) & (i < j))


def merge_sort(s: Suffixes, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes by (group, suffix); ``group`` is ascending.

    Bottom-up merge sort inside the groups, all merges of a level at once: each member finds
    its rank in the neighbouring run by binary search with hash comparisons."""
    n = len(group)
    order = np.arange(n)
    if not n:
        return order
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    number = np.cumsum(np.concatenate([[False], group[1:] != group[:-1]]))
    base, end = first[number], np.append(first[1:], n)[number]
    at = np.arange(n)
    width, longest = 1, int((end - base).max())
    while width < longest:
        run = (at - base) // width
        other = base + (run ^ 1) * width            # start of the run to merge with
        lo, hi = np.minimum(other, end), np.minimum(other + width, end)
        begin = lo.copy()
        me = order[at]
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            before = s.less(order[mid], me[open_])
            lo[open_] = np.where(before, mid + 1, lo[open_])
            hi[open_] = np.where(before, hi[open_], mid)
        left = base + (run & ~1) * width             # start of the merged run
        place = left + (at - (base + run * width)) + (lo - begin)
        merged = np.empty(n, np.int64)
        merged[place] = me
        order, width = merged, width * 2
    return order


def _verified_common(s: Suffixes, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common extensions of sorted neighbours, checked byte by byte."""
    n = s.common(i, j)
    for at in range(0, len(n), 4096):
        part = slice(at, at + 4096)
        wide = np.arange(int(n[part].max(initial=0)))
        inside = wide < n[part][:, None]
        top = len(s.buf) - 1
        x = s.buf[np.minimum(s.start[i[part]][:, None] + wide, top)]
        y = s.buf[np.minimum(s.start[j[part]][:, None] + wide, top)]
        wrong = (x != y) & inside
        if wrong.any():
            raise ValueError("two different strings share a hash; use another base")
    return n


def repeated_windows(group: np.ndarray, contents: list[bytes], place: np.ndarray,
                     length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Ranges of each stretch covered by windows that occur in another one of its group.

    ``group`` is ascending, ``place`` is the place's offset in the stretch. A stretch's
    windows are those that start in 0 .. len - length."""
    n = len(contents)
    size = np.array([len(c) for c in contents], np.int64)
    whole = np.frombuffer(b"".join(contents), np.uint8)
    start = np.cumsum(size) - size
    right = Suffixes(whole, start + place, size - place)
    flipped = whole[::-1]
    left = Suffixes(flipped, len(whole) - (start + place), place)
    classes = []
    for s in (right, left):
        order = merge_sort(s, group)
        same = np.zeros(n, np.int64)
        if n > 1:
            i, j = order[:-1], order[1:]
            near = np.flatnonzero(group[i] == group[j])
            same[1:][near] = _verified_common(s, i[near], j[near])
        edge = np.concatenate([[True], group[order[1:]] != group[order[:-1]]])
        classes.append((order, same, edge))
    found = [[] for _ in range(n)]
    most = int(place.max(initial=0))
    for a in range(0, most + 1):
        # windows that start ``a`` bytes before the place
        has = (place >= a) & (size - place >= length - a)
        if has.sum() < 2:
            continue
        key = []
        for (order, same, edge), need in zip(classes, (length - a, a)):
            k = np.empty(n, np.int64)
            k[order] = np.cumsum(edge | (same < need))
            key.append(k)
        k = (key[0] * np.int64(n + 1) + key[1])[has]
        who = np.flatnonzero(has)
        _, back, counts = np.unique(k, return_inverse=True, return_counts=True)
        for i in who[counts[back] > 1].tolist():
            found[i].append(int(place[i]) - a)
    return [_covered(x, length) for x in found]


def _covered(starts: list[int], length: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a in sorted(starts):
        if out and a <= out[-1][1]:
            out[-1][1] = a + length
        else:
            out.append([a, a + length])
    return [tuple(x) for x in out]


# ---- the operator ----------------------------------------------------------------------

_RANGES = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()),
                                    T.StructField("b", T.IntegerType())]))


def _sorted_groups(reps: DataFrame, length: int) -> DataFrame:
    """h, d, ranges: covered ranges, within the stretch, of the stretches of each place hash."""
    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("d", T.LongType()),
                           T.StructField("ranges", _RANGES)])
    arrow = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def solve(rows):
        h = np.array([r[0] for r in rows], np.int64)
        got = repeated_windows(h, [r[2] for r in rows], np.array([r[3] for r in rows], np.int64),
                               length)
        keep = [(r[0], r[1], [{"a": a, "b": b} for a, b in x]) for r, x in zip(rows, got) if x]
        cols = list(zip(*keep)) if keep else [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], arrow)], names=["h", "d", "ranges"])

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in ("h", "d", "content", "place")]):
                if held > 4 << 20 and rows[-1][0] != r[0]:  # groups are whole
                    yield solve(rows)
                    rows, held = [], 0
                rows.append(r)
                held += len(r[2])
        if rows:
            yield solve(rows)

    return reps.select("h", "d", "content", "place").repartition("h").sortWithinPartitions(
        "h").mapInArrow(run, schema)


def _hot_windows(reps: DataFrame, length: int) -> DataFrame:
    """Like _sorted_groups for very large groups: counts digests of single windows."""
    at = F.explode(F.sequence(F.lit(0), F.octet_length("content") - length))
    win = reps.select("h", "d", "place", "content", at.alias("w"))
    win = win.select("h", "d", "w", (F.col("place") - F.col("w")).alias("off"),
                     F.md5(F.expr(f"substring(content, w + 1, {length})")).alias("m"))
    twice = win.groupBy("h", "off", "m").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    got = win.join(twice, ["h", "off", "m"], "left_semi")
    return got.groupBy("h", "d").agg(F.collect_list(F.struct(
        F.col("w").alias("a"), (F.col("w") + length).alias("b"))).alias("ranges"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, spans, kept (bytes)."""
    if not gram <= length <= 1 << (PACK - 1):
        raise ValueError(f"length is from gram to {1 << (PACK - 1)}")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    frame = docs.select(F.col(f"`{id_col}`").alias("__id"), text.alias("__text"))
    # documents with equal keys have equal texts, and so equal ranges
    frame = frame.withColumn("__k1", F.xxhash64("__text")).withColumn(
        "__k2", F.hash("__text"))
    rows = _emit(frame, length, gram)
    twice = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("d").alias("d0"),
                                  F.max("d").alias("d1")).where("c > 1").select(
        F.col("h").alias("g"), (F.col("d0") == F.col("d1")).alias("alike"))
    rows = reliable_checkpoint(rows.join(twice, F.col("h") == F.col("g")).drop("g"))
    start = F.shiftright("at", 2 * PACK).cast("int")
    size = F.shiftright("at", PACK).bitwiseAND(F.lit((1 << PACK) - 1)).cast("int")
    place = F.col("at").bitwiseAND(F.lit((1 << PACK) - 1)).cast("int")
    unpacked = rows.select("h", "d", "__k1", "__k2", start.alias("s"), (start + size).alias("e"),
                           (start + place).alias("p"), "alike")
    alike = unpacked.where("alike").select("__k1", "__k2", "s", "e")
    mixed = unpacked.where("not alike")
    # one stretch of each digest stands for all; those that occur twice repeat as a whole
    stands = mixed.groupBy("h", "d").agg(F.count(F.lit(1)).alias("c"), F.min(
        F.struct("__k1", "__k2", "s", "e", "p")).alias("r"))
    groups = stands.groupBy("h").agg(F.count(F.lit(1)).alias("many"))
    stands = stands.join(groups, "h").select(
        "h", "d", "c", "many", F.col("r.__k1").alias("f1"), F.col("r.__k2").alias("f2"),
        F.col("r.s").alias("s"), F.col("r.e").alias("e"), (F.col("r.p") - F.col("r.s")).alias("place"))
    texts = frame.select("__k1", "__k2", "__text")
    asked = stands.select("h", "d", "many", "f1", "f2", "s", "e", "place").distinct()
    # the texts to cut from: fewer than all, and broadcast keys only while they are few
    holders = reliable_checkpoint(asked.select(F.col("f1").alias("g1"), F.col("f2").alias("g2")).distinct())
    if holders.count() <= BROADCAST_KEYS:
        texts = texts.join(F.broadcast(holders), (F.col("__k1") == F.col("g1"))
                           & (F.col("__k2") == F.col("g2")), "left_semi")
    reps = texts.join(asked, (F.col("__k1") == F.col("f1")) & (F.col("__k2") == F.col("f2"))).select(
        "h", "d", "many", "place",
        F.expr("substring(cast(__text as binary), s + 1, e - s)").alias("content"))
    # equal texts all match the key of their stretch: one of them is enough
    reps = reliable_checkpoint(reps.groupBy("h", "d").agg(
        F.first("many").alias("many"), F.first("place").alias("place"),
        F.first("content").alias("content")))
    partial = _sorted_groups(reps.where(F.col("many") <= hot), length).unionByName(
        _hot_windows(reps.where(F.col("many") > hot), length))
    whole = stands.where("c > 1").select("h", "d", F.lit(None).cast(_RANGES).alias("ranges"))
    verdict = partial.unionByName(whole).groupBy("h", "d").agg(
        F.max(F.col("ranges").isNull()).alias("all"), F.first("ranges", True).alias("ranges"))
    verdict = verdict.select(F.col("h").alias("vh"), F.col("d").alias("vd"), "all", "ranges")
    edges = mixed.join(verdict, (F.col("h") == F.col("vh")) & (F.col("d") == F.col("vd"))).select(
        "__k1", "__k2", F.explode(F.when(F.col("all"), F.array(F.struct(
            F.col("s").alias("a"), F.col("e").alias("b")))).otherwise(F.transform(
                "ranges", lambda x: F.struct((x["a"] + F.col("s")).alias("a"),
                                             (x["b"] + F.col("s")).alias("b"))))).alias("x"))
    ranges = alike.select("__k1", "__k2", F.struct(F.col("s").alias("a"), F.col("e").alias("b"))
                          .alias("x")).unionByName(edges)
    # a document's ranges are bounded by its own length, and equal ones are met once
    ranges = ranges.groupBy("__k1", "__k2").agg(F.collect_set("x").alias("ranges")).select(
        F.col("__k1").alias("r1"), F.col("__k2").alias("r2"), "ranges")
    out = frame.join(ranges, (F.col("__k1") == F.col("r1")) & (F.col("__k2") == F.col("r2")), "left")
    return _cut(out.select("__id", "__text", "ranges"), id_col)


def _cut(frame: DataFrame, id_col: str) -> DataFrame:
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                     T.StructField("end", T.IntegerType())]))
    schema = T.StructType([T.StructField(id_col, frame.schema["__id"].dataType),
                           T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()),
                           T.StructField("n_spans", T.LongType()), T.StructField("spans", span),
                           T.StructField("kept", T.BinaryType())])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            cols = [[] for _ in range(5)]
            for raw, ranges in zip(X.documents(batch, "__text"),
                                   batch.column("ranges").to_pylist()):
                spans: list[list[int]] = []
                for a, b in sorted((x["a"], x["b"]) for x in ranges or ()):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                for c, v in zip(cols, (len(raw), sum(b - a for a, b in spans), len(spans),
                                       [{"start": a, "end": b} for a, b in spans],
                                       b"".join(kept))):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), *[pa.array(c, pa.int64()) for c in cols[:3]],
                 pa.array(cols[3], arrow), pa.array(cols[4], pa.binary())], names=schema.names)

    return frame.mapInArrow(run, schema)

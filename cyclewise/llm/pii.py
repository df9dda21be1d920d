"""Personal data: protected entities by pattern, then information-theoretic sanitisation.

Entities are e-mail and IP addresses, card numbers (Luhn) and phone numbers. The words around an
entity can give it back after it is taken out. How strongly a word reveals an entity is estimated
from the whole corpus: with n(e) documents that hold the entity, n(w) that hold the word, n(e, w)
that hold the word within ``REACH`` words of the entity, and N in all, the word discloses

    PMI(e; w) = log( n(e, w) N / (n(e) n(w)) )

of the entity's information IC(e) = log( N / n(e) ). Words whose share PMI / IC reaches
``DISCLOSURE`` exceed the threshold; a co-occurrence that all comes from copies of one text is no
estimate and does not count. Near the entity such a word is generalised to its first ``PREFIX``
characters where the class of all words that begin so stays under the threshold for every entity
there (counted in the same way), and is removed otherwise. Documents without an entity stay as
they are.

Each pattern is matched leftmost and without overlap per kind; a match that fails its length,
range or check digit is dropped and consumed. Scanning is linear in the text, whatever it holds.
Offsets are code points of the original text, ends exclusive.

Plan: one pass finds entities and the words near them; pairs, entities and words are counted by
partial aggregates on 64-bit hashes (words of a task together before they are sent), so a hot
entity or word is one row per task. Only spans and hashes are shuffled. Texts are joined back,
by row, when ``with_text`` asks for the sanitised texts.

Defined cases: a null or empty text has no spans; an entity that every document holds carries no
information and discloses nothing; repeated documents each get their row and count each;
rows are told apart by position, so ids may repeat or be null; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.llm import text as X
from cyclewise.session import reliable_checkpoint

KINDS = ("email", "ip", "card", "phone")
REACH = 5  # words on either side of an entity
DISCLOSURE = 0.9  # share of an entity's information above which a word goes
PREFIX = 3  # characters of a word's class
HELD = 1 << 20  # words counted in a task before they are sent on
BROADCAST_KEYS = 1_000_000  # words or pairs up to which a table goes to every task

_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a run of digits always matches, so that none of it is read twice
_IP = re.compile(rb"[0-9]++(?:(?:\.[0-9]++){3})?+")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_CLASS_SALT = np.uint64(0x5851F42D4C957F2D)


def _emails(raw: bytes) -> Iterator[tuple[int, int]]:
    floor, at = 0, raw.find(b"@")
    while at >= 0:
        before = raw[floor:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        m = _DOMAIN.match(raw, at + 1) if local else None
        if m:
            yield at - local, m.end()
        floor = m.end() if m else at + 1
        at = raw.find(b"@", floor)


def _luhn(digits: bytes) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = (c - 48) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(raw: bytes) -> bytes:
    return raw.translate(None, b" ().+-")


def _small(part: bytes) -> bool:
    part = part.lstrip(b"0")
    return len(part) <= 3 and int(part or b"0") <= 255


def entities(raw: bytes) -> list[tuple[int, int, int, bytes]]:
    """(kind as a place in KINDS, start, end, plain value) in byte offsets, by kind, then start."""
    out = [(0, a, b, raw[a:b].lower()) for a, b in _emails(raw)]
    for m in _IP.finditer(raw):
        if b"." in m[0] and all(map(_small, m[0].split(b"."))):
            out.append((1, *m.span(), m[0]))
    for m in _CARD.finditer(raw):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append((2, *m.span(), d))
    if b"+" in raw:
        for m in _PHONE.finditer(raw):
            if 8 <= len(d := _digits(m[0])) <= 15:
                out.append((3, *m.span(), d))
    return out


def _class_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the first PREFIX code points of words."""
    first = np.full((len(starts), PREFIX + 1), len(buf), np.int64)
    first[:, 0] = starts
    for k in range(1, PREFIX + 1):  # the next code point begins one to four bytes on
        at = first[:, k - 1] + 1
        for _ in range(3):
            inside = np.minimum(at, len(buf) - 1)
            at = at + ((at < ends) & ((buf[inside] & 0xC0) == 0x80))
        first[:, k] = at
    cut = np.minimum(first[:, PREFIX], ends)
    return X.mix64(X.span_hashes(X.LOWER[buf], starts, cut) ^ _CLASS_SALT)


def _words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return X.words(buf, X.ALNUM, lower=True)


def _value_hash(kind: int, value: bytes) -> int:
    return int.from_bytes(blake2b(b"%d:" % kind + value, digest_size=8).digest(), "little", signed=True)


def near_words(raw: bytes, found: list[tuple[int, int, int, bytes]], reach: int = REACH):
    """Words outside all entities within ``reach`` words of one: arrays of entity, word and class
    hashes, code-point starts and ends, and whether the (entity, word) and the (entity, class) of
    a place are the document's first."""
    buf = np.frombuffer(raw, np.uint8)
    starts, ends, hashes = _words(buf)
    a = np.array([x[1] for x in found])
    b = np.array([x[2] for x in found])
    e = np.array([_value_hash(x[0], x[3]) for x in found], np.int64)
    # words that touch an entity are left out: edges +1 and -1 of the entities, counted up to a word
    order_a, order_b = np.sort(a), np.sort(b)
    touched = np.searchsorted(order_a, ends, "left") > np.searchsorted(order_b, starts, "right")
    starts, ends, hashes = starts[~touched], ends[~touched], hashes[~touched]
    before = np.searchsorted(starts, a)[:, None] - np.arange(1, reach + 1)
    after = np.searchsorted(starts, b)[:, None] + np.arange(reach)
    place = np.concatenate([before, after], axis=1)
    owner = np.repeat(e, 2 * reach)[(ok := ((place >= 0) & (place < len(starts))).ravel())]
    place = place.ravel()[ok]
    order = np.lexsort((place, owner))
    owner, place = owner[order], place[order]
    new = np.ones(len(place), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    owner, place = owner[new], place[new]
    words = hashes[place].view(np.int64)
    used, back = np.unique(place, return_inverse=True)
    classes = _class_hashes(buf, starts[used], ends[used])[back].view(np.int64) if len(used) else words
    return (owner, words, classes, X.code_points(buf, starts[place]), X.code_points(buf, ends[place]),
            _first(owner, words), _first(owner, classes))


def _first(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a pair (a, b) is the first of its kind."""
    out = np.zeros(len(a), bool)
    if len(a):
        order = np.lexsort((np.arange(len(a)), b, a))
        new = np.append(True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0))
        out[order[new]] = True
    return out


_NEAR = [("e", pa.int64()), ("t", pa.int64()), ("g", pa.int64()), ("start", pa.int64()),
         ("end", pa.int64()), ("ft", pa.bool_()), ("fg", pa.bool_())]
_NEAR_SQL = "array<struct<e:bigint,t:bigint,g:bigint,start:bigint,end:bigint,ft:boolean,fg:boolean>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _find(reach: int):
    def run(batches):
        for batch in batches:
            base, owners, sizes, parts = [], [], [], []
            for raw in X.documents(batch, "text"):
                found = entities(raw)
                sizes.append(0)
                if not found:
                    base.append([])
                    owners.append([])
                    continue
                at = X.code_points(np.frombuffer(raw, np.uint8), np.array([x[1:3] for x in found])).tolist()
                base.append([{"kind": KINDS[x[0]], "start": s, "end": t} for x, (s, t) in zip(found, at)])
                owners.append(sorted({_value_hash(x[0], x[3]) for x in found}))
                near = near_words(raw, found, reach)
                sizes[-1] = len(near[0])
                parts.append(near)
            columns = [np.concatenate(x) if parts else np.empty(0, np.int64) for x in
                       (zip(*parts) if parts else [()] * len(_NEAR))]
            near = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _NEAR)],
                                              names=[n for n, _ in _NEAR])
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            rest = [batch.column(k) for k in range(batch.num_columns) if batch.schema.names[k] != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(base, pa.list_(_SPAN)), pa.array(owners, pa.list_(pa.int64())),
                 pa.ListArray.from_arrays(offsets, near)], names=[*names, "base", "owners", "near"])
    return run


def _count_words(batches):
    """Documents that hold each word or class, as (w, n), for the words a task has held so far."""
    held, size = [], 0

    def rows():
        w, n = np.unique(np.concatenate(held), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n, pa.int64())],
                                         names=["w", "n"])

    for batch in batches:
        for raw in X.documents(batch, "text"):
            buf = np.frombuffer(raw, np.uint8)
            starts, ends, hashes = _words(buf)
            if not len(starts):
                continue
            words, at = np.unique(hashes, return_index=True)
            held += [words, np.unique(_class_hashes(buf, starts[at], ends[at]))]
            size += len(held[-1]) + len(held[-2])
            if size > HELD:
                yield from rows()
                held, size = [], 0
    if held:
        yield from rows()


def _discloses(both: str, entity: str, word: str, total: Column, share: float) -> Column:
    information = F.log(total / F.col(entity))
    return (information > 0) & (F.log(F.col(both) * total / (F.col(entity) * F.col(word)))
                                >= share * information - 1e-9)


def _maybe_broadcast(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= limit else df


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH,
         share: float = DISCLOSURE, with_text: bool = False,
         broadcast_keys: int | None = None) -> DataFrame:
    """One row per document: id, base spans (kind, start, end), disclosing words (start, end,
    removed) and, ``with_text``, the sanitised text."""
    limit = BROADCAST_KEYS if broadcast_keys is None else broadcast_keys
    frame = X.pick(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    if with_text:  # rows keep their number, so that texts find their spans again
        frame = reliable_checkpoint(frame.withColumn("row", F.monotonically_increasing_id()))
    kind = frame.schema["id"].dataType.simpleString()
    found = frame.withColumn("h", F.xxhash64("text")).mapInArrow(
        _find(reach), f"id {kind}, {'row bigint, ' if with_text else ''}h bigint, "
        "base array<struct<kind:string,start:bigint,end:bigint>>, owners array<bigint>, "
        f"near {_NEAR_SQL}")
    if not with_text:
        found = found.withColumn("row", F.monotonically_increasing_id())
    found = reliable_checkpoint(found)
    total = F.lit(found.count()).cast("double")

    near = found.select("row", "h", F.explode("near").alias("x")).select("row", "h", "x.*")
    seen = near.where("ft").select("e", F.col("t").alias("w"), "h").unionByName(
        near.where("fg").select("e", F.col("g").alias("w"), "h"))
    both = (seen.groupBy("e", "w").agg(F.count("*").alias("n_both"), F.min("h").alias("lo"), F.max("h").alias("hi"))
            .where("lo < hi").select("e", "w", "n_both"))
    both = reliable_checkpoint(both)
    wanted = reliable_checkpoint(both.select("w").distinct())
    held = (frame.select("text").mapInArrow(_count_words, "w bigint, n bigint")
            .join(_maybe_broadcast(wanted, limit), "w", "left_semi")
            .groupBy("w").agg(F.sum("n").alias("n_word")))
    owned = found.select(F.explode("owners").alias("e")).groupBy("e").agg(F.count("*").alias("n_entity"))
    telling = reliable_checkpoint(
        both.join(held, "w").join(owned, "e")
        .where(_discloses("n_both", "n_entity", "n_word", total, share)).select("e", "w"))

    known = _maybe_broadcast(telling, limit)
    hits = (near.select("row", "e", "g", F.col("t").alias("w"), "start", "end").join(known, ["e", "w"])
            .select("row", "e", "start", "end", F.col("g").alias("w"))
            .join(known.withColumn("too", F.lit(True)), ["e", "w"], "left")
            .groupBy("row", "start", "end").agg(F.max(F.coalesce("too", F.lit(False))).alias("removed"))
            .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "removed"))).alias("terms")))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,removed:boolean>>")
    out = found.select("row", "id", "base").join(hits, "row", "left").withColumn(
        "terms", F.coalesce("terms", empty))
    if not with_text:
        return out.select(F.col("id").alias(id_col), "base", "terms")
    return out.join(frame.select("row", "text"), "row").select(
        F.col("id").alias(id_col), "base", "terms", _sanitised("text", "base", "terms").alias("sanitised"))


@F.arrow_udf(T.StringType())
def _sanitised(text: pa.Array, base: pa.Array, terms: pa.Array) -> pa.Array:
    """Entities as ``<kind>``, generalised words as their prefix and ``*``, removed ones gone; a
    span inside an earlier one goes with it."""
    out = []
    for t, spans, words in zip(text.to_pylist(), base.to_pylist(), terms.to_pylist()):
        marks = [(x["start"], -x["end"], f"<{x['kind']}>") for x in spans or []]
        marks += [(x["start"], -x["end"], "" if x["removed"] else t[x["start"]:x["start"] + PREFIX] + "*")
                  for x in words or []]
        parts, past = [], 0
        for start, end, mark in sorted(marks):
            if start < past:
                past = max(past, -end)
                continue
            parts += [t[past:start], mark]
            past = -end
        out.append("".join([*parts, (t or "")[past:]]))
    return pa.array(out, pa.string())

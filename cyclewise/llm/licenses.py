"""License scan: winnowed fingerprints in an inverted index, then banded alignment.

Templates and documents are read as words (digits, letters and non-ASCII characters, A-Z
lower-cased). Hashes of ``GRAM`` consecutive words are winnowed: of every ``WINDOW``
consecutive hashes the least is kept, the rightmost of equals. The templates' fingerprints
form an inverted index (hash to template and position); a document's fingerprints that hit
it propose (template, diagonal) candidates. Each candidate is aligned with its template
inside a band of ``BAND`` words around the diagonal (match +2, mismatch -1, gap -1, local),
which reports the matched share of the template and the span in the document.

A shared run of GRAM + WINDOW - 1 words always gives a candidate; templates shorter than
that are indexed with all their hashes, and documents are looked up with all of theirs, so
that short notices are found too.

The templates are a small table of public notices; ``templates`` may be any list whose
words stay under ``MAX_TEMPLATE_WORDS`` (checked), since every task holds the index.

Defined cases: null, empty and very short texts match nothing; several occurrences of one
template are reported as several spans; equal scores keep the leftmost; repeated rows get
equal results; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.llm import text as X

GRAM = 4
WINDOW = 4
BAND = 8
MIN_COVERAGE = 0.6
MAX_TEMPLATE_WORDS = 1_000_000

# fixed values: public license notices
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
     "use this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International "
     "License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met"),
]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return X.words(np.frombuffer(raw, np.uint8), X.ALNUM, lower=True)


def winnow(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the winnowed hashes: the rightmost least of each window."""
    if not len(h):
        return np.empty(0, np.int64)
    w = min(window, len(h))
    views = np.lib.stride_tricks.sliding_window_view(h, w)
    last = w - 1 - np.argmin(views[:, ::-1], axis=1)
    return np.unique(np.arange(len(views)) + last)


class Index:
    """Templates' words and the inverted index of their fingerprints."""

    def __init__(self, templates, gram: int = GRAM, window: int = WINDOW):
        self.gram, self.names, self.words = gram, [], []
        hashes, owner, at = [], [], []
        for k, (name, text) in enumerate(templates):
            _, _, w = word_hashes(text.encode())
            self.names.append(name)
            self.words.append(w)
            g = X.ngram_hashes(w, min(gram, max(len(w), 1)))
            keep = winnow(g, window) if len(w) >= gram + window else np.arange(len(g))
            hashes.append(g[keep])
            owner.append(np.full(len(keep), k))
            at.append(keep)
        if sum(map(len, self.words)) > MAX_TEMPLATE_WORDS:
            raise ValueError("the templates are too large to be held by every task")
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.owner = np.concatenate(owner)[order] if len(h) else np.empty(0, np.int64)
        self.at = np.concatenate(at)[order] if len(h) else np.empty(0, np.int64)

    def hits(self, w: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """Template to its (document position, template position) fingerprint hits, in order."""
        out: dict[int, list[tuple[int, int]]] = {}
        g = X.ngram_hashes(w, self.gram)
        if not len(self.hash) or not len(g):
            return out
        lo, hi = np.searchsorted(self.hash, g, "left"), np.searchsorted(self.hash, g, "right")
        for p in np.flatnonzero(hi > lo).tolist():
            for k in range(lo[p], hi[p]):
                out.setdefault(int(self.owner[k]), []).append((p, int(self.at[k])))
        return out


def align(doc: np.ndarray, template: np.ndarray, diagonal: int, band: int = BAND,
          lo: int = 0, hi: int | None = None):
    """Best local alignment inside the band: (score, matched words, start, end) or None.

    Cell (i, j) pairs template word i with document word j in [lo, hi),
    |j - i - diagonal| <= band. A match scores 2, a mismatch or gap -1; of equal scores more
    matched words, then the earlier start win. The three are one number per cell, so that a row
    of the band is a few array steps: a gap along the row is a running maximum."""
    hi = len(doc) if hi is None else hi
    n, off, width = len(template), diagonal - band, 2 * band + 1
    # bits of a cell: 22 score, 20 matched words, 21 the start counted back from the band's first
    late, match_unit, score_unit = (1 << 21) - 1, 1 << 21, 1 << 41
    steps = score_unit * np.arange(width)  # cost of coming along the row
    base = np.arange(width)
    above = late - base  # score 0, no match, start j
    best, best_key = None, 0
    for i in range(n):
        j = base + off + i
        inside = (j >= lo) & (j < hi)
        fresh = late - (base + i + 1)
        same = np.zeros(width, bool)
        same[inside] = doc[j[inside]] == template[i]
        key = above + np.where(same, 2 * score_unit + match_unit, -score_unit)
        key[:-1] = np.maximum(key[:-1], above[1:] - score_unit)
        key = np.where(inside, key, fresh)
        key = np.maximum.accumulate(key + steps) - steps
        above = np.where(inside & (key >= score_unit), key, fresh)
        top = above >> 21
        if top.max() > best_key:
            b = int(top.argmax())
            best_key = int(top[b])
            best = (best_key >> 20, best_key & ((1 << 20) - 1), off + late - int(above[b] & late), int(j[b]) + 1)
    return best


def _verbatim(doc: np.ndarray, template: np.ndarray, diagonal: int, lo: int, hi: int):
    """The first place of the band where the template stands word for word: no alignment of the
    band scores more, and of those that score as much it is the first."""
    n = len(template)
    for at in range(max(diagonal - BAND, lo), min(diagonal + BAND, hi - n) + 1):
        if doc[at] == template[0] and np.array_equal(doc[at:at + n], template):
            return 2 * n, n, at, at + n
    return None


def _shared(doc: np.ndarray, words: np.ndarray, counts: np.ndarray) -> int:
    """Most template words that an alignment with these document words can match."""
    if not len(doc):
        return 0
    at = np.searchsorted(words, doc)
    at[at == len(words)] = 0
    return int(np.minimum(np.bincount(at[words[at] == doc], minlength=len(words)), counts).sum())


def find(raw: bytes, index: Index, min_coverage: float = MIN_COVERAGE) -> list[dict]:
    """Matches of a document: license, coverage of its template, span in characters."""
    s, e, w = word_hashes(raw)
    found = []
    for k, hits in sorted(index.hits(w).items()):
        template = index.words[k]
        needed, (distinct, counts) = min_coverage * len(template), np.unique(template, return_counts=True)
        places = [p for p, _ in hits]
        parts = [(0, len(w))]  # stretches of the document in which to look for occurrences
        while parts:
            lo, hi = parts.pop()
            tried: set[int] = set()
            for h in range(bisect_left(places, lo), bisect_left(places, hi)):
                p, t = hits[h]
                if p - t in tried:
                    continue
                tried.add(p - t)
                got = _verbatim(w, template, p - t, lo, hi)
                if not got:
                    window = w[max(p - t - BAND, lo):min(p - t + BAND + len(template), hi)]
                    if _shared(window, distinct, counts) < needed:
                        continue
                    got = align(w, template, p - t, lo=lo, hi=hi)
                if got and got[1] >= needed:
                    found.append((got[2], got[3], got[1], k))
                    parts += [(lo, got[2]), (got[3], hi)]
                    break
    if not found:
        return []
    # overlapping matches: the one with more matched words stays, then the leftmost
    found = sorted(set(found), key=lambda x: (-x[2], -x[2] / len(index.words[x[3]]), x[0], x[3]))
    kept: list[tuple] = []
    for f in found:
        k = bisect_left(kept, f)
        if (k == 0 or kept[k - 1][1] <= f[0]) and (k == len(kept) or f[1] <= kept[k][0]):
            kept.insert(k, f)
    at = X.code_points(np.frombuffer(raw, np.uint8),
                       np.array([[s[a], e[b - 1]] for a, b, *_ in kept]))
    return [{"license": index.names[k], "template": k, "matched": m,
             "coverage": m / len(index.words[k]), "start": a, "end": b}
            for (_, _, m, k), (a, b) in zip(kept, at.tolist())]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates=TEMPLATES, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per document: id and its matches in text order."""
    frame = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    match = T.StructType([T.StructField("license", T.StringType()),
                          T.StructField("template", T.IntegerType()),
                          T.StructField("matched", T.LongType()),
                          T.StructField("coverage", T.DoubleType()),
                          T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([frame.schema.fields[0], T.StructField("licenses", T.ArrayType(match))])
    arrow = pa.list_(pa.struct([("license", pa.string()), ("template", pa.int32()),
                                ("matched", pa.int64()), ("coverage", pa.float64()),
                                ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        index = Index(templates)
        for batch in batches:
            out = [find(raw, index, min_coverage) for raw in X.documents(batch, "__text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, arrow)],
                                             names=schema.names)

    return frame.mapInArrow(run, schema)

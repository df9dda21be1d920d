"""Periodic runs against brute force, defined cases and hostile texts."""

import hashlib
import re
import time
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from cyclewise.llm import periodic_runs as P
from cyclewise.llm import queries as Q


def brute(w):
    """All maximal stretches by trying every period."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(6, 4 * q))


words = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=14)
docs = st.builds(lambda a, b, k, c: a + b * k + c, words, words, st.integers(0, 9), words)


@settings(max_examples=400, deadline=None)
@given(st.lists(docs, max_size=4))
def test_equal_brute_force(texts):
    got = [[tuple(r) for r in x.tolist()] for x in P.runs_of_each(texts)]
    assert got == [brute(w) for w in texts]


def test_small_chunks_and_steps(monkeypatch):
    texts = [([b"x", b"y"] * 9 + [b"z"] * k) for k in range(20)]
    want = [brute(w) for w in texts]
    monkeypatch.setattr(P, "CHUNK", 30)
    monkeypatch.setattr(P, "STEP", 5)
    assert [[tuple(r) for r in x.tolist()] for x in P.runs_of_each(texts)] == want


def test_hostile_texts_are_fast():
    x, y = [b"a"], [b"a", b"b"]
    while len(y) < 200_000:
        x, y = y, y + x
    began = time.time()
    assert len(P.runs_of_each([y])[0]) == 0  # no fourth power in a Fibonacci word
    assert P.runs_of_each([[b"a"] * 300_000])[0].tolist() == [[0, 300_000, 1]]
    assert P.runs_of_each([[b"w" * 50_000_000]])[0].tolist() == []
    assert time.time() - began < 20


SCHEMA = "doc_id long, text string, n_runs string, Text string"


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode()) & 0xFFFFFFFF
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3),
            1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_rows_and_defined_cases(spark):
    rows = [(k, " ".join("ab c"[(k * j) % 4] + "ü" for j in range(k % 40)), "x", None) for k in range(120)]
    rows += [(None, "a a a a a a a", None, None), (7, None, None, None), (8, "", "", ""), (8, "", "", ""),
             (10, "b\u00a0c \u00a0 " * 7, None, None), (1009, " x\tx\nx\x0bx\x0cx\rx x x", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = P.find_runs(df, tails=True, with_text=False).collect()
    assert Counter(map(str, map(tuple, got))) == Counter(str(expected(r[0], r[1])) for r in rows)
    full = {r.doc_id: r for r in P.find_runs(df).collect()}
    assert full[1009].collapsed == "x" and [tuple(x) for x in full[1009].runs] == [(0, 8, 1)]
    assert P.find_runs(df.limit(0)).count() == 0


SF = "/root/testdata/sf0.001"


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    small = [r for r in docs if len((r.text or "").split()) <= 300]
    got = {r.doc_id: tuple(r) for r in Q.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    assert all(got[r.doc_id] == expected(r.doc_id, r.text) for r in small)

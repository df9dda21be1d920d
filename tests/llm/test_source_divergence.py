"""Source divergence against a plain loop over all terms and pairs, and defined cases."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from cyclewise.llm import source_divergence as D


def f(p, q):
    return (p - q) ** 2 // (p + q)


def brute(rows, min_docs, top):
    rows = [tuple("" if x is None else str(x) for x in r) for r in rows]
    counts, docs, groups = {}, Counter(), {}
    for text, lang, source in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        counts.setdefault((lang, source), Counter()).update(words)
        docs.update((lang, w) for w in set(words))
        groups.setdefault(lang, set()).add(source)
    out = []
    for lang, sources in groups.items():
        kept = [w for (x, w), n in docs.items() if x == lang and n >= min_docs]
        v = len(kept)

        def shares(count):
            n = sum(count[w] for w in kept)
            return {w: 1 + 10**9 * (count[w] + 2) // (n + 2 * v) for w in kept}

        share = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            found = sorted((-sum(f(share[s][w], share[o][w]) for w in kept), o.encode()) for o in sources if o != s)
            out += [(lang, s, "pair", o.decode(), -x, k + 1) for k, (x, o) in enumerate(found)]
            found = sorted((-f(share[s][w], whole[w]), w.encode()) for w in kept
                           if counts[lang, s][w] and share[s][w] > whole[w])[:top]
            out += [(lang, s, "term", w.decode(), -x, k + 1) for k, (x, w) in enumerate(found)]
    return sorted(out)


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = ["The", "the", "été", "Äx", "x1y", "no-se", "a", "b", "c", "d", "e", "漢字", "zz", "q" * 300]
    rows = []
    for _ in range(n):
        source = rng.choice(["s1", "s2", "s10", "S", "é", None, ""])
        text = " ".join(rng.choice(words[:rng.randint(1, len(words))]) for _ in range(rng.randint(0, 30)))
        rows.append((rng.choice([text, text.upper(), None]), rng.choice(["en", "fr", None]), source))
    rows += [("only here", "xx", "s1"), ("", "xx", "s2"), (None, "yy", None)]
    return rows


@pytest.mark.parametrize("seed,min_docs,top", [(1, 10, 10), (2, 3, 2), (3, 1, 10), (4, 10**6, 10)])
def test_equal_plain_loop(spark, seed, min_docs, top):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "text string, lang string, source string, Lang string, value int")
    got = D.audit(df, min_docs=min_docs, top=top).collect()
    assert sorted(map(tuple, got)) == brute(rows, min_docs, top)


def test_other_paths_agree(spark, monkeypatch):
    """Flushed counters, small blocks and groups too many to broadcast change nothing."""
    rows = corpus(5)
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    want = sorted(map(tuple, D.audit(df, min_docs=2).collect()))
    assert want == brute(rows, 2, 10)
    monkeypatch.setattr(D, "BROADCAST_GROUPS", 0)
    assert sorted(map(tuple, D.audit(df, min_docs=2).collect())) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert D.audit(df).collect() == []


def test_tree_equals_all_pairs():
    """Corrections of the tree are those of every pair of every row, however rows are cut."""
    rng = random.Random(7)
    for _ in range(200):
        rows = Counter()
        for _ in range(rng.randint(1, 40)):
            chosen = sorted(rng.sample(range(6), rng.randint(1, 6)))
            rows[tuple((s, rng.choice([50, 70, 900]), 10 + s) for s in chosen)] += rng.randint(1, 5)
        want = Counter()
        for row, n in rows.items():
            for (a, pa, za), (b, pb, zb) in combinations(row, 2):
                want[a, b] += n * (f(pa, pb) - f(pa, zb) - f(za, pb) + f(za, zb))
        got, order = Counter(), sorted(rows)
        cut = rng.randint(0, len(order))
        for part in (order[:cut], order[cut:]):
            columns = [[np.array([x[k] for x in row], np.int64) for row in part] for k in range(3)]
            for a, b, v in D.tree_corrections(*columns, np.array([rows[r] for r in part], np.int64)):
                got[a, b] += v
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_counter_is_flushed_when_full(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(D, "HELD", 3)
    texts = [f"w{'x' * k} a a B" for k in range(9)]
    batch = pa.record_batch([pa.array(texts), pa.array(["l"] * 9), pa.array(["s"] * 9)],
                            names=["text", "lang", "source"])
    total, docs, parts = Counter(), Counter(), 0
    for out in D._count(iter([batch])):
        parts += 1
        for r in out.to_pylist():
            total[r["term"]] += r["n"]
            docs[r["term"]] += r["docs"]
    assert parts > 2 and total["a"] == 18 and docs["a"] == 9 and total["b"] == 9


def test_blocks(monkeypatch):
    import pyarrow as pa
    rows = [("l" if k < 6 else "m", [{"s": s, "p": 20 + (k + s) % 3, "z": 5} for s in range(1 + k % 4)], 1 + k)
            for k in range(12)]
    rows.sort(key=lambda r: (r[0], [tuple(x.values()) for x in r[1]]))
    item = pa.struct([("s", pa.int32()), ("p", pa.int64()), ("z", pa.int64())])
    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.list_(item)),
                             pa.array([r[2] for r in rows], pa.int64())], names=["lang", "row", "times"])

    def total():
        out = Counter()
        for part in D._corrections(iter([batch])):
            for r in part.to_pylist():
                out[r["lang"], r["a"], r["b"]] += r["value"]
        return out

    want = total()
    monkeypatch.setattr(D, "BLOCK", 4)
    assert total() == want and len(want) > 3

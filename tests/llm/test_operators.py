"""Training-data operators against brute force, on small fixtures and the smallest tables."""

import collections
import hashlib
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cyclewise.llm import (chat, decontaminate, licenses, mixing, ngram_join, quality_classifier,
                           quality_rules, queries, secrets, shard, suffix_dedup, text as X)

SF = "/root/testdata/sf0.001"
WS = r"[^\x20\x09-\x0D]+"
LOWER = {i: i + 32 for i in range(65, 91)}
SLOW = 2  # times a machine may be slower than the stated limits


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, a clashing extra column."""
    long = " ".join(f"w{i % 977}é" for i in range(60_000))
    rows = [(1, "same words here again and again", "a", 5), (1, "same words here again and again", "a", 5),
            (2, None, None, None), (None, "text without an id", "b", 1), (3, "", "a", 2),
            (4, long, "b", 3), (5, long, None, 4), (None, None, None, None), (6, " \t\n ", "a", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int")


def run(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# ---- text helpers


def test_words_and_hashes_match_python():
    rng = random.Random(3)
    t = "".join(rng.choice("ab é\tXz9\n|#€") for _ in range(5000))
    buf = np.frombuffer(t.encode(), np.uint8)
    s, e, h = X.words(buf, X.NOT_SPACE, lower=True)
    got = [t.encode()[a:b].decode() for a, b in zip(s, e)]
    assert got == re.findall(WS, t)
    by = collections.defaultdict(set)
    for w, x in zip(got, h.tolist()):
        by[w.translate(LOWER)].add(x)
    assert all(len(v) == 1 for v in by.values()) and len({min(v) for v in by.values()}) == len(by)


def test_words_do_not_depend_on_segments(monkeypatch):
    t = ("abc déf " * 400 + "x" * 3000 + " y").encode()
    want = X.words(np.frombuffer(t, np.uint8), X.NOT_SPACE)
    monkeypatch.setattr(X, "SEGMENT", 64)
    got = X.words(np.frombuffer(t, np.uint8), X.NOT_SPACE)
    assert all(np.array_equal(a, b) for a, b in zip(want, got))


# ---- chat


def test_chat_rotation_matches_brute_force(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "é hello"), (1, 3, "ann", None),
            (2, 0, "system", "alone"), (3, 0, None, "x"), (3, 0, "", "x"), (3, None, "cy", "end"),
            (None, 5, "dee", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["perspective"]): r for r in run(chat.render(chat.rotate(df, block=2)))}
    want = {}
    for conv in {r[0] for r in rows}:
        turns = [(t, r or "unknown", x or "") for c, t, r, x in rows if c == conv]
        for me in {r for _, r, _ in turns} - {"system"}:
            out, mask = "", []
            for _, r, x in sorted(turns, key=lambda z: (z[0] is None, z[0] or 0, z[1], z[2])):
                out += {"system": "<|system|>\n", me: "<|assistant|>\n"}.get(r, f"<|user name={r}|>\n")
                if r == me:
                    mask.append({"start": len(out), "end": len(out) + len(x) + len("<|end|>")})
                out += x + "<|end|>\n"
            want[(conv, me)] = {"conv_id": conv, "perspective": me, "text": out, "mask": mask}
    assert got == want


def test_chat_offsets_do_not_depend_on_blocks(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    a, b = (sorted(map(str, chat.rotate(df, block=n).collect())) for n in (1, 4096))
    assert a == b and len(a) > 0
    assert chat.rotate(df.limit(0)).count() == 0


# ---- licenses


def test_license_scan_finds_whole_and_edited_templates(spark):
    apache = licenses.TEMPLATES[1][1]
    words = apache.split()
    edited = " ".join(words[:12] + ["really"] + words[12:20] + words[21:])
    rows = [(1, "Été. " + apache + " Then prose."), (2, "x y z " + edited), (3, "nothing at all"),
            (4, None), (5, ""), (6, "Released under the MIT License. Text. Released under the MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in run(licenses.scan_licenses(df))}
    assert [m["license"] for m in got[1]] == ["Apache-2.0"] and got[1][0]["coverage"] == 1.0
    assert rows[0][1][got[1][0]["start"]:got[1][0]["end"]] == apache
    assert [m["license"] for m in got[2]] == ["Apache-2.0"] and got[2][0]["coverage"] > 0.9
    assert got[3] == got[4] == got[5] == []
    assert [m["license"] for m in got[6]] == ["MIT", "MIT"]


def test_banded_alignment_equals_full_alignment():
    rng = np.random.default_rng(1)
    for _ in range(20):
        t = rng.integers(0, 50, 20).astype(np.uint64)
        d = np.concatenate([rng.integers(50, 99, 7), t[:9], [77], t[9:14], t[15:], [88]]).astype(np.uint64)
        band, full = licenses.align(d, t, 7), licenses.align(d, t, 0, band=200)
        assert band == full and band[1] == 19


def test_license_index_finds_all_short_notices(docs):
    index = licenses.Index(licenses.TEMPLATES)
    notices = [x for _, x in licenses.TEMPLATES]
    for t in docs.text:
        found = licenses.find(t.encode(), index)
        assert len(found) >= sum(n in t for n in notices[:1] + notices[2:3])


# ---- secrets


def brute_secrets(t):
    out, n = [], {}
    for kind, pattern, ok in [
            ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                                  r"([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[2]) >= 6),
            ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
            ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24)]:
        got = [(m.start(), kind, m.end()) for m in pattern.finditer(t) if ok(m)]
        n[kind] = len(got)
        out += got
    out.sort(key=lambda x: (x[0], ["assign", "access", "hex"].index(x[1])))
    return n, hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in out).encode()).hexdigest()


def test_secret_query_matches_brute_force(spark, docs):
    got = {r["doc_id"]: r for r in run(queries.QUERIES["op3_secrets"](spark, SF))}
    assert len(got) == len(docs)
    for i, t in zip(docs.doc_id, docs.text):
        n, digest = brute_secrets(t)
        r = got[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == (
            n["assign"], n["access"], n["hex"], digest)


def test_secret_spans_on_random_text_and_checksums(spark):
    rng = random.Random(7)
    bits = ["password", "PASSWD", "tok", "token", "api_key", "apikey", "secret", " ", "=", ":", "\"", "'",
            "AKIA", "A1B2", "é", "deadbeef", "0123456789abcdef", "x", "\n", "ſecret", "Kelvin"]
    texts = ["".join(rng.choice(bits) for _ in range(60)) for _ in range(300)]
    for t in texts:
        hits = [(k, a, b) for k, a, b in secrets.find(t.encode()) if k in secrets.BASE_KINDS]
        n, _ = brute_secrets(t)
        assert collections.Counter(k for k, _, _ in hits) == +collections.Counter(n)
    body = "abcdefghijklmnopqrstuvwxyz0123"
    good = "ghp_" + body + secrets.checksum62(body.encode()).decode()
    df = spark.createDataFrame([(1, "é " + good), (2, "ghp_" + "x" * 36), (3, None)], "doc_id int, text string")
    got = {r["doc_id"]: r["secrets"] for r in run(secrets.scan_secrets(df))}
    assert got[1] == [{"kind": "github", "start": 2, "end": 42}] and got[2] == got[3] == []


# ---- quality classifier


def test_classifier_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op4_quality_classifier"](spark, sf).toPandas()
    labels = pd.read_parquet(f"{sf}/labels.parquet")
    held = got[got.held_out].merge(labels, on="doc_id")
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id[:500], got.held_out[:500]))
    assert (held.predicted == held.quality).mean() > 0.97
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()


def test_classifier_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 0), (None, 1)], "doc_id long, quality int")
    got = run(quality_classifier.classify(odd, labels, keep=["doc_id"]))
    assert len(got) == 9 and all(0 <= r["score"] <= 1 for r in got)
    assert quality_classifier.classify(odd.limit(0), labels.limit(0)).count() == 0


# ---- repeated strings


def brute_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, int)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, bytes(np.frombuffer(r, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("length,gram,hot", [(200, 32, 20_000), (60, 16, 20_000), (60, 16, 1)])
def test_repeats_match_brute_force(spark, docs, length, gram, hot):
    some = docs.head(120)
    df = spark.createDataFrame(some[["doc_id", "text"]])
    got = {r["doc_id"]: r for r in run(suffix_dedup.remove_repeats(df, length=length, gram=gram, hot=hot))}
    for i, want in zip(some.doc_id, brute_repeats(some.text, length)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want


def test_repeats_chunks_and_odd_rows(spark, odd, monkeypatch):
    rng = random.Random(5)
    part = "".join(rng.choice("abcde ") for _ in range(900))
    t = part + "X" * 700 + part[:400] + "Y"
    want = brute_repeats([t], 200)[0]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    h, s, e, p = suffix_dedup.stretches(np.frombuffer(t.encode(), np.uint8))
    assert set().union(*[range(a, b - 199) for a, b in zip(s, e)]) == set(range(len(t) - 199))
    df = spark.createDataFrame([(1, t)], "doc_id int, text string")
    r = run(suffix_dedup.remove_repeats(df))[0]
    assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == want
    got = run(suffix_dedup.remove_repeats(odd))
    assert len(got) == 9 and sum(r["n_removed"] == r["n_bytes"] > 0 for r in got) == 2
    assert suffix_dedup.remove_repeats(odd.limit(0)).count() == 0


def test_merge_sort_orders_suffixes():
    rng = np.random.default_rng(2)
    buf = rng.integers(97, 99, 400).astype(np.uint8)
    start = np.sort(rng.choice(390, 60, replace=False))
    group = np.sort(rng.integers(0, 3, 60))
    s = suffix_dedup.Suffixes(buf, start, np.minimum(9, 400 - start))
    order = suffix_dedup.merge_sort(s, group)
    key = [(group[i], bytes(buf[start[i]:start[i] + 9]), i) for i in range(60)]
    assert [key[i] for i in order] == sorted(key)


# ---- mixing


def test_mix_odd_rows_and_targets(spark, odd):
    got = run(mixing.mix(odd, keep=["doc_id"]))
    assert len(got) == 9 and all(0 <= r["copies"] <= 3 for r in got)
    assert sorted(r["size"] for r in got) == [0, 0, 0, 0, 4, 6, 6, 60000, 60000]
    assert mixing.mix(odd.limit(0), keep=["doc_id"]).count() == 0


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        level = rest / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level > 3 * sizes[s]]
        if not over:
            return target | {s: w[s] * level for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= target[s]
            free.remove(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 77}, {"x": 3},
                                   {"a": 1, "b": 1, "c": 1, "d": 5000}, {"a": 0, "b": 9}])
def test_targets_match_iterative_sharing(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["__source"]: r["target"] for r in run(mixing.source_targets(df))}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_takes_near_target_and_does_not_depend_on_buckets(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    a = mixing.mix(df, keep=["doc_id", "source"]).toPandas()
    b = mixing.mix(df.repartition(7), keep=["doc_id", "source"], buckets=3).toPandas()
    a, b = (x.sort_values("doc_id").reset_index(drop=True) for x in (a, b))
    pd.testing.assert_frame_equal(a, b)
    for _, g in a.groupby("source"):
        assert abs((g["size"] * g.copies).sum() - g.target.iloc[0]) <= g["size"].max()
    weighted = mixing.mix(df, keep=["doc_id", "source"], weight_col="n_chars").toPandas()
    assert weighted.copies.max() <= 3


# ---- n-gram join


def brute_join(texts, ids, k=4, percent=85):
    sets = []
    for t in texts:
        w = re.findall(WS, (t or "").translate(LOWER))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = {}
    for x in range(len(sets)):
        r = root(x)
        least[r] = min(least.get(r, ids[x]), ids[x])
    return {ids[x]: (len(sets[x]), least[root(x)]) for x in range(len(sets))}


@pytest.mark.parametrize("few,rounds", [(100, 6), (0, 2)])
def test_join_matches_brute_force(spark, docs, monkeypatch, few, rounds):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
    rng = random.Random(11)
    rows = list(zip(docs.doc_id, docs.text))
    base = [f"w{i}" for i in range(60)]
    for i in range(40):  # one group of near copies, chained
        words = base[:]
        words[rng.randrange(60)] = f"z{i}"
        rows.append((1000 + i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(ngram_join.similar_components(df))}
    assert got == brute_join([t for _, t in rows], [i for i, _ in rows])


@pytest.mark.parametrize("pool,k,percent", [(0.0, 4, 85), (0.3, 4, 85), (20.0, 4, 85), (0.3, 5, 80)])
def test_join_does_not_depend_on_the_pool(spark, docs, monkeypatch, pool, k, percent):
    """However few or many shingles are counted first, and however texts share passages."""
    monkeypatch.setattr(ngram_join, "POOL", pool)
    rng = random.Random(3)
    rows = list(zip(docs.doc_id, docs.text))
    passage = " ".join(f"p{i}" for i in range(40))
    for i in range(60):  # own words around one passage: most without partner, some near copies
        own = " ".join(f"o{i // 3}_{j}" for j in range(rng.choice([3, 60, 400])))
        rows.append((2000 + i, f"{passage} {own}" + (" x" if i % 2 else "")))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in run(ngram_join.similar_components(df, k=k, percent=percent, count_links=False))}
    assert got == brute_join([t for _, t in rows], [i for i, _ in rows], k, percent)


def test_join_drops_far_pairs_where_postings_meet(spark):
    """Texts that share a shingle by chance make no row; near ones do."""
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**64 - 1, 200, np.uint64)) for _ in range(30)]
    sets.append(np.unique(np.append(sets[0][:195], sets[1][:5])))
    side = [(i, 200 << 31, [int(x) for x in ngram_join.sketch(s)]) for i, s in enumerate(sets)]
    rows = [(*x, *y) for x in side for y in side if x[0] < y[0]]
    df = spark.createDataFrame(rows, "a long, anp long, asketch array<long>, b long, bnp long, bsketch array<long>")
    assert run(ngram_join._filtered(df, 85)) == [{"a": 0, "b": 30, "times": 1}]


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_sketches_differ_no_more_than_sets(percent):
    rng = np.random.default_rng(percent)
    for n in (1, 5, 60, 4000):
        a = np.unique(rng.integers(0, 2**64 - 1, n, np.uint64))
        b = np.unique(np.append(a[rng.integers(0, 10, len(a)) > 0], rng.integers(0, 2**64 - 1, n // 10, np.uint64)))
        differ = sum(int(x).bit_count() for x in (ngram_join.sketch(a) ^ ngram_join.sketch(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b))


def test_runs_of_sorted_rows():
    import pyarrow as pa
    rng = np.random.default_rng(0)
    for _ in range(300):
        t = np.sort(rng.integers(0, rng.integers(1, 12), rng.integers(0, 40)))
        c = np.arange(len(t))
        cuts = np.sort(rng.integers(0, len(t) + 1, rng.integers(0, 6)))
        parts = [pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)), pa.array(y.astype(np.int64))], names=["token", "c"])
                 for x, y in zip(np.split(t, cuts), np.split(c, cuts))]
        got = [np.concatenate(x) if x else np.empty(0) for x in (list(zip(*ngram_join._runs(iter(parts)))) or ([], [], []))]
        size = np.array([(t == v).sum() if t[0] != v != t[-1] else 0 for v in t])
        assert got[0].tolist() == t.tolist() and got[1].tolist() == c.tolist() and got[2].tolist() == size.tolist()


def test_join_of_a_large_group_grows_with_its_rows(spark, monkeypatch):
    """Near copies of one text: the pairs that meet are a few per posting, not the group's square."""
    met, filtered = [], ngram_join._filtered

    def counted(pairs, percent):
        out = filtered(pairs, percent)
        met.append(out.selectExpr("sum(times)").first()[0] or 0)
        return out

    monkeypatch.setattr(ngram_join, "_filtered", counted)
    base, size = [f"w{i}" for i in range(200)], {}
    for m in (30, 120):
        met.clear()
        texts = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1:])) for i in range(10, 10 + m)]
        got = run(ngram_join.similar_components(spark.createDataFrame(texts, "doc_id long, text string"), count_links=False))
        assert len(got) == m and {r["component_id"] for r in got} == {10}
        size[m] = sum(met)
    assert size[120] <= 6 * size[30]


def broadcasts(df):
    """(joins that a table of keys is sent to every task for, joins that a sieve is sent for)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("BroadcastHashJoin"), plan.count("BroadcastNestedLoopJoin")


@pytest.mark.parametrize("n,bits", [(0, 1 << 26), (900, 1 << 26), (5000, 1 << 26), (5000, 1 << 10)])
def test_many_keys_are_not_broadcast(spark, monkeypatch, n, bits):
    """Beyond the bound a sieve of fixed size is sent, and the same rows are found."""
    monkeypatch.setattr(ngram_join, "BROADCAST_KEYS", 1000)
    monkeypatch.setattr(ngram_join, "SIEVE_BITS", bits)
    frame = spark.range(20_000).selectExpr("xxhash64(id) AS h", "id")
    keys = spark.createDataFrame([(i,) for i in range(n)], "k long").selectExpr("xxhash64(k * 3) AS wanted")
    inside, outside = ngram_join.among(frame, keys, "h"), ngram_join.without(frame, keys, "h")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert broadcasts(inside) == ((0, 1) if n > 1000 else (1, 0))
        assert broadcasts(outside) == ((0, 2) if n > 1000 else (1, 0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = set(range(0, min(3 * n, 20_000), 3))
    assert {r["id"] for r in run(inside)} == want
    assert sorted(r["id"] for r in run(outside)) == sorted(set(range(20_000)) - want)


def test_join_with_sieves_matches_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_KEYS", 0)
    rows = list(zip(docs.doc_id, docs.text))
    rows += [(i + 5000, t) for i, t in rows[:40]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in run(ngram_join.similar_components(df, count_links=False))}
    assert got == brute_join([t for _, t in rows], [i for i, _ in rows])


def test_join_odd_rows(spark, odd):
    got = run(ngram_join.similar_components(odd))
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in got) == [
        (0, 0, 0), (0, 1, 0), (1, 3, 1), (1, 3, 1), (2, 0, 2), (3, 0, 3), (4, 977, 4), (5, 977, 4), (6, 0, 6)]
    assert ngram_join.similar_components(odd.limit(0)).count() == 0


@pytest.mark.parametrize("block,size", [(2048, 1 << 20), (4, 1 << 20), (2048, 600)])
def test_join_counts_every_link(spark, docs, monkeypatch, block, size):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", size)
    monkeypatch.setattr(ngram_join, "COLUMNS", 32)
    rng = random.Random(5)
    texts = list(docs.text)
    for i in range(25):  # near copies of three lengths: bands, and links beyond a spanning tree
        words = [f"w{j}" for j in range(rng.choice([120, 132, 144]))]
        for j in rng.sample(range(120), rng.randrange(2)):
            words[j] = f"z{i}"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_links"] for r in run(ngram_join.similar_components(df))}
    sets = []
    for t in texts:
        w = re.findall(WS, (t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset())
    classes = set(sets)
    want = {i: sum(1 for o in classes if o != s and 100 * len(s & o) >= 85 * len(s | o)) if s else 0
            for i, s in enumerate(sets)}
    assert got == want and max(want.values()) > 5


# ---- decontamination


def brute_hits(t, items, window=10):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    w = re.findall(word, (t or "").translate(LOWER))
    hit, ids = set(), set()
    for item, raw in items:
        x = re.findall(word, (raw or "").translate(LOWER))
        n = min(window, len(x))
        for i in range(max(1, len(x) - window + 1)) if x else ():
            for j in range(len(w) - n + 1):
                if w[j:j + n] == x[i:i + n]:
                    hit |= set(range(j, j + n))
                    ids.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(ids)


@pytest.mark.parametrize("part_bytes", [2_000_000, 60])
def test_decontamination_matches_brute_force(spark, part_bytes):
    q = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    items = [(1, q), (2, "Only Three! words"), (10, "beta gamma"), (None, "été 42"), (3, None), (4, "..."),
             (2, "gamma delta")]
    texts = [q, "x " + q.upper() + " y", "only, three WORDS and beta", None, "", "été-42 Gamma... delta",
             q.replace("eta ", "ETA; ")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("n_hit", F.lit(9))
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = {r["doc_id"]: r for r in run(decontaminate.scan_benchmark(df, bench, part_bytes=part_bytes))}
    for i, t in enumerate(texts):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["item_ids"]) == brute_hits(t, items)
    assert texts[1][got[1]["spans"][0]["start"]:got[1]["spans"][-1]["end"]].lower() == q
    assert decontaminate.scan_benchmark(df, bench.limit(0)).where("n_hit > 0").count() == 0


# ---- quality rules


def brute_rules(t):
    t = t or ""
    w = re.findall(WS, t)
    grams = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(WS, x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
            len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_rules_match_brute_force(spark, docs, odd):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for source in (spark.createDataFrame(docs[["doc_id", "text"]]), odd):
        texts = source.select("text").toPandas().text
        got = collections.Counter(tuple(r[n] for n in names) for r in run(quality_rules.clean_lines(source)))
        assert got == collections.Counter(brute_rules(t) for t in texts)


def test_line_rules():
    prose = "A clean line of words ends here.\n" + "Another one with other words follows it here."
    assert quality_rules.judge(prose.encode())["kept"]
    bad = "Home | About | Contact\nbuy###now$$$ all%%%\n" * 3 + prose
    got = quality_rules.judge(bad.encode())
    assert got["cleaned"].decode() == prose
    assert quality_rules.line_fails(b"Home | About | Contact.") == "navigation"
    assert quality_rules.line_fails(b"Please read our privacy policy.") == "boilerplate"


# ---- sharding


def test_shards_slots_and_growth(spark, odd):
    df = spark.range(3000).withColumnRenamed("id", "doc_id").union(spark.range(50).withColumn("id", F.lit(7)))
    got = shard.shard_documents(df, "doc_id", 40, buckets=16).toPandas()
    assert len(got) == 3050
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    moved = got[got.shard != got.grown_shard]
    assert (moved.grown_shard == 40).all() and 30 < len(moved) < 130
    assert got.groupby("doc_id").shard.nunique().max() == 1
    weights = df.select(shard.shard_column("doc_id", [3.0, 1.0]).alias("s")).groupBy("s").count().toPandas()
    assert 2.3 < weights.set_index("s")["count"][0] / weights.set_index("s")["count"][1] < 4
    clash = shard.shard_documents(odd.withColumn("slot", F.lit("x")), "doc_id", 3)
    assert clash.count() == 9 and clash.schema["slot"].dataType.simpleString() == "bigint"
    assert shard.shard_documents(odd.limit(0)).count() == 0


def test_shard_query_columns(spark, docs):
    got = queries.QUERIES["op10_shard"](spark, SF).toPandas().set_index("doc_id")
    for i, t in zip(docs.doc_id, docs.text):
        assert (got["size"][i], got.text_crc32[i]) == (len(t.encode()) + 16, zlib.crc32(t.encode()))


# ---- hostile texts
@pytest.mark.parametrize("piece", ["Released under the MIT License. ", licenses.TEMPLATES[1][1] + " ", "under the MIT "])
def test_license_scan_of_one_notice_over_and_over(piece):
    index, began = licenses.Index(licenses.TEMPLATES), time.time()
    n = 1_000_000 // len(piece)
    found = licenses.find((piece * n).encode(), index)
    assert time.time() - began < 5 * SLOW
    assert len(found) == (n if licenses.find(piece.encode(), index) else 0)


def plain_align(doc, template, diagonal, band, lo, hi):
    """The band cell by cell: best (score, matched, -start) of each cell."""
    n, best, cell = len(template), None, {}
    for i in range(-1, n):
        for j in range(i + diagonal - band, i + diagonal + band + 1):
            fresh = (0, 0, -(j + 1))
            if i < 0 or not lo <= j < hi:
                cell[i, j] = fresh
                continue
            same = int(template[i] == doc[j])
            options = [(cell[i - 1, j - 1], 2 if same else -1, same)]
            options += [(cell[c], -1, 0) for c in ((i - 1, j), (i, j - 1)) if c in cell]
            top = max((s + ds, m + dm, b) for (s, m, b), ds, dm in options)
            cell[i, j] = top if top[0] > 0 else fresh
            if top[0] > 0 and (best is None or top[:2] > best[:2]):
                best = (top[0], top[1], -top[2], j + 1)
    return best


def test_license_alignment_equals_the_band_cell_by_cell():
    rng = np.random.default_rng(5)
    for _ in range(200):
        doc = rng.integers(0, 5, rng.integers(1, 40)).astype(np.uint64)
        template = rng.integers(0, 5, rng.integers(1, 15)).astype(np.uint64)
        diagonal, band = int(rng.integers(-8, 30)), int(rng.integers(1, 6))
        lo = int(rng.integers(0, len(doc)))
        hi = int(rng.integers(lo, len(doc) + 1))
        assert licenses.align(doc, template, diagonal, band, lo, hi) == plain_align(doc, template, diagonal, band, lo, hi)


@pytest.mark.parametrize("piece", [b"eyJ", b"eyJ.", b"eyJa.b ", b"token", b"token=", b"AKIA", b"-----BEGIN A ", b"0123456789abcdef"])
def test_secret_scan_is_linear(piece):
    began = time.time()
    secrets.find(piece * (1_000_000 // len(piece)))
    assert time.time() - began < 5 * SLOW


def test_web_tokens_in_one_run():
    head = b"eyJhbGciOiJIUzI1NiJ9"
    token = head + b".eyJzdWIiOiIxIn0.c2ln"
    for text, n in ((b"eyJx eyJ" + token, 0), (b"eyJeyJ " + token, 1), (token + b"." + token, 2),
                    (b"eyJ." + token, 1), (token + b" " + token, 2), (b"eyJeyJeyJ.", 0)):
        plain = [m.span() for m in re.finditer(rb"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", text)
                 if text[m.start():m.start() + len(head)] == head]
        assert [(a, b) for k, a, b in secrets.find(text) if k == "jwt"] == plain, text
        assert len(plain) == n


def test_word_without_end_is_hashed_by_pieces():
    rng = np.random.default_rng(3)
    word = rng.integers(97, 123, 3 * X.SEGMENT + 5).astype(np.uint8)
    text = np.concatenate([np.frombuffer(b"ab ", np.uint8), word, np.frombuffer(b" ab", np.uint8)])
    starts, ends, h = X.words(text, X.NOT_SPACE)
    total = 0
    for at, b in enumerate(word[:50].tolist()):
        total += (b + 1) * pow(int(X._BASE), at, 1 << 64)
    short = X.mix64(np.array([total & (2**64 - 1)], np.uint64) + np.uint64(50) * X._M1)[0]
    assert X._long_hash(word[:50]) == short == X.span_hashes(word, np.array([0]), np.array([50]))[0]
    assert h[0] == h[2] and h[1] == X._long_hash(word) and ends[1] - starts[1] == len(word)


def test_word_of_fifty_megabytes():
    raw = np.full(50_000_000, 97, np.uint8)
    began = time.time()
    tracemalloc.start()
    assert len(X.words(raw, X.NOT_SPACE, lower=True)[2]) == 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * len(raw) and time.time() - began < 5 * SLOW


def test_code_points_of_byte_places():
    text = "aé漢𝄞b é"
    raw = np.frombuffer(text.encode(), np.uint8)
    at = np.array([len(text[:k].encode()) for k in range(len(text) + 1)])
    assert X.code_points(raw, at).tolist() == list(range(len(text) + 1))

"""Personal data: base spans against the plain expressions, disclosing words against a plain count."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cyclewise.llm import pii
from cyclewise.llm import queries as Q

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def digits(x):
    return "".join(c for c in x if c in "0123456789")


def luhn(d):
    twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def base(text):
    """(kind, start, end, value) by the expressions as they are given."""
    out = [("email", *m.span(), m[0].lower()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span(), m[0]) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span(), d) for m in CARD.finditer(text) if 16 <= len(d := digits(m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span(), d) for m in PHONE.finditer(text) if 8 <= len(d := digits(m[0])) <= 15]
    return out


def low(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def brute(rows, reach=pii.REACH, share=pii.DISCLOSURE):
    """(id, base spans, disclosing words) of rows (id, text), counted in plain dictionaries."""
    total = len(rows)
    n_e, n_w, both, texts, docs = Counter(), Counter(), Counter(), defaultdict(set), []
    for _, text in rows:
        text = text or ""
        found = base(text)
        words = [(m[0], *m.span()) for m in WORD.finditer(low(text))]
        n_w.update({w for w, _, _ in words} | {("class", w[:pii.PREFIX]) for w, _, _ in words})
        free = [w for w in words if not any(w[1] < b and a < w[2] for _, a, b, _ in found)]
        near = set()
        for kind, a, b, value in found:
            left = [w for w in free if w[1] < a][-reach:]
            right = [w for w in free if w[1] >= b][:reach]
            near |= {((kind, value), w) for w in left + right}
        n_e.update({(k, v) for k, _, _, v in found})
        pairs = {(e, w[0]) for e, w in near} | {(e, ("class", w[0][:pii.PREFIX])) for e, w in near}
        both.update(pairs)
        for p in pairs:
            texts[p].add(text)
        docs.append((found, near))

    def discloses(e, w):
        if len(texts[e, w]) < 2 or n_e[e] == total:
            return False
        ic = math.log(total / n_e[e])
        return math.log(both[e, w] * total / (n_e[e] * n_w[w])) >= share * ic - 1e-9

    out = []
    for (i, _), (found, near) in zip(rows, docs):
        marks = {}
        for e, (w, a, b) in near:
            if discloses(e, w):
                marks[a, b] = marks.get((a, b), False) or discloses(e, ("class", w[:pii.PREFIX]))
        out.append((i, [x[:3] for x in found], sorted((a, b, r) for (a, b), r in marks.items())))
    return out


def rows_of(df):
    return sorted(str((r[0], [tuple(x) for x in r.base], [tuple(x) for x in r.terms])) for r in df.collect())


ALPHABET = st.sampled_from(list("a1.@- +()9,é\n") + ["4111111111111111", "1.2.3.4", "a@b.c", "+1 (22) 333-4444", "256."])


@settings(max_examples=500, deadline=None)
@given(st.lists(ALPHABET, max_size=25).map("".join))
def test_base_spans_equal_plain_expressions(text):
    raw = text.encode()
    at = [len(raw[:k].decode(errors="ignore")) for k in range(len(raw) + 1)]
    assert [(pii.KINDS[k], at[a], at[b], v.decode()) for k, a, b, v in pii.entities(raw)] == base(text)


def test_hostile_texts_are_linear():
    for piece in (b"a", b"1", b"@", b"a@", b"1.", b"+1 ", b"+", b"a.b-", b"a@b", b"1 ", b"0.", b"+1(((", b"\xc3\xa9"):
        raw = piece * (2_000_000 // len(piece))
        began = time.time()
        pii.entities(raw)
        assert time.time() - began < 5, piece
    raw = b"x@y.zz " * 100_000
    began = time.time()
    assert len(pii.near_words(raw, pii.entities(raw))[0]) == 0
    assert time.time() - began < 10


def corpus(seed, n=120):
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "Été", "in", "über"] + [f"w{k}" for k in range(30)]
    people = [("ann@x.org", "Annabel"), ("+1 (663) 555-6869", "Bob"), ("10.0.0.1", "gateway"), ("4111111111111111", "visa")]
    rows = []
    for k in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(3, 40))]
        if rng.random() < 0.4:
            value, name = rng.choice(people)
            at = rng.randint(0, len(words))
            words[at:at] = [name, value] if rng.random() < 0.8 else [value]
        rows.append((k, " ".join(words)))
    copy = "unique words by lone@mail.example.com stay because one text is no estimate"
    return rows + [(500 + k, copy) for k in range(5)] + [(None, None), (7, ""), (7, ""), (None, "Ann@x.org é")]


@pytest.mark.parametrize("seed,share", [(1, 0.9), (2, 0.5), (3, 1.0)])
def test_equal_plain_count(spark, seed, share):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows],
                               "doc_id long, text string, base string, Text int, h int")
    want = brute(rows, share=share)
    assert rows_of(pii.scan(df, share=share)) == sorted(map(str, want))
    assert any(w for _, _, w in want) and not any(w for i, _, w in want if i and i >= 500)
    assert rows_of(pii.scan(df, share=share, broadcast_keys=0)) == sorted(map(str, want))


def test_sanitised_text(spark):
    rows = [(k, f"mail from Zebedee zeb@x.org about {w} things") for k, w in enumerate("one two three four".split())]
    rows += [(10 + k, f"zebra about {w} things mail from others") for k, w in enumerate("five six seven eight".split())]
    got = {r.doc_id: r for r in pii.scan(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()}
    # the name gives the address away; its class, shared with other words, does not
    assert got[0].sanitised == "mail from Zeb* <email> about one things"
    assert got[10].sanitised == rows[4][1] and got[10].terms == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pii.scan(df).collect() == [] and pii.scan(df, with_text=True).collect() == []


def test_tasks_send_words_on(monkeypatch):
    import pyarrow as pa
    texts = [f"alpha w{k} w{k}" for k in range(9)]
    batch = pa.record_batch([pa.array(texts)], names=["text"])

    def counts():
        out, parts = Counter(), 0
        for part in pii._count_words(iter([batch])):
            parts += 1
            for r in part.to_pylist():
                out[r["w"]] += r["n"]
        return out, parts

    want, one = counts()
    monkeypatch.setattr(pii, "HELD", 4)
    got, many = counts()
    assert got == want and one == 1 and many > 2 and max(want.values()) == 9


def test_query_equals_plain_count(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in Q.QUERIES["op11_pii"](spark, SF).collect()}
    assert len(got) == len(docs)
    for i, spans, terms in brute(docs):
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in spans) for k in pii.KINDS]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans == ",".join([*([text] if text else []), *[f"term:{a}:{b}" for a, b, _ in terms]])

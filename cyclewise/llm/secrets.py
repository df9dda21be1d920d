"""Secret scan: Aho-Corasick keyword prefilter, anchored expressions near hits, checksums.

A document's bytes are lower-cased (A-Z only) and scanned once by an automaton of the
keywords below. Each hit anchors the expression of its kind at the hit's start; nothing
else of the text is matched. A run of hexadecimal digits has no keyword in it, so its
anchor comes from a second automaton over the text's character classes, whose single
keyword is 24 times "hexadecimal digit". Kinds with an embedded check (GitHub and npm
tokens end in a base-62 CRC-32, a web token's header is base64 JSON) count only when it
holds.

Matches are leftmost and do not overlap within a kind; a match that fails its length or
check is dropped but still consumed. Offsets are code points of the original text.

Defined cases: a null or empty text has no spans; ties at one start go by the order of
KINDS; repeated documents each get their row; ids of any type pass through; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.llm import text as X

BASE_KINDS = ("assign", "access", "hex")
# fixed values: kinds in their order, the keywords that lead to each, public token formats
KINDS = (*BASE_KINDS, "github", "npm", "jwt", "pem")
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "apikey", "api_key"],
    "access": ["akia"],
    "github": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
    "npm": ["npm_"],
    "jwt": ["eyj"],
    "pem": ["-----begin "],
}
EXPRESSIONS = {
    "assign": re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                         rb"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]+"),
    "github": re.compile(rb"gh[pousr]_([A-Za-z0-9]+)"),
    "npm": re.compile(rb"npm_([A-Za-z0-9]+)"),
    "jwt": re.compile(rb"(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++"),
    "pem": re.compile(rb"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
}
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_RUN = 24
# a run of these ends at the same place for all of its anchors: where one fails, they all fail
_JWT_RUN = re.compile(rb"[A-Za-z0-9_-]++")

_HEX_CLASS = bytes(0x68 if chr(i) in "0123456789abcdef" else 0x2E for i in range(256))


def _automaton(words: dict[str, list[str]]):
    auto = ahocorasick.Automaton()
    for kind, keys in words.items():
        for k in keys:
            auto.add_word(k, (kind, len(k)))
    auto.make_automaton()
    return auto


_KEYS = _automaton(KEYWORDS)
_RUNS = _automaton({"hex": ["h" * HEX_RUN]})


def checksum62(body: bytes) -> bytes:
    """Six base-62 digits of the CRC-32 of ``body``, as public token formats embed it."""
    v, out = zlib.crc32(body), b""
    for _ in range(6):
        v, d = divmod(v, 62)
        out = BASE62[d:d + 1] + out
    return out


def _valid(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[2]) >= 6
    if kind == "access":
        return len(m[0]) >= 20
    if kind == "hex":
        return len(m[0]) >= HEX_RUN
    if kind in ("github", "npm"):
        return len(m[1]) == 36 and checksum62(m[1][:30]) == m[1][30:]
    if kind == "jwt":
        try:
            head = json.loads(base64.urlsafe_b64decode(m[1] + b"=" * (-len(m[1]) % 4)))
        except (binascii.Error, ValueError):
            return False
        return isinstance(head, dict) and "alg" in head
    return True


def find(raw: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in byte offsets, by start and then by kind as listed."""
    if not raw:
        return []
    out, past = [], dict.fromkeys(KINDS, 0)
    low = raw.lower().decode("latin-1")
    anchors = [(last + 1 - n, kind) for last, (kind, n) in _KEYS.iter(low)]
    classes = raw.translate(_HEX_CLASS).decode("latin-1")
    inside = -1  # end of the hexadecimal run that the last hit lies in
    for last, _ in _RUNS.iter(classes):
        if last >= inside:
            inside = EXPRESSIONS["hex"].match(raw, last + 1 - HEX_RUN).end()
            anchors.append((last + 1 - HEX_RUN, "hex"))
    for at, kind in sorted(anchors):
        if at < past[kind]:
            continue
        m = EXPRESSIONS[kind].match(raw, at)
        if m:
            past[kind] = m.end()
            if _valid(kind, m):
                out.append((kind, at, m.end()))
        elif kind == "jwt" and (m := _JWT_RUN.match(raw, at)):
            past[kind] = m.end()
    out.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, spans as an array of (kind, start, end) in code points."""
    frame = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType())])
    schema = T.StructType([frame.schema.fields[0], T.StructField("secrets", T.ArrayType(span))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            out = []
            for raw in X.documents(batch, "__text"):
                hits = find(raw)
                if hits:
                    at = X.code_points(np.frombuffer(raw, np.uint8),
                                       np.array([[a, b] for _, a, b in hits]))
                    hits = [{"kind": k, "start": a, "end": b}
                            for (k, _, _), (a, b) in zip(hits, at.tolist())]
                out.append(hits)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, arrow)],
                                             names=schema.names)

    return frame.mapInArrow(run, schema)

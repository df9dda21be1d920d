"""Line-first quality rules.

Every line with a word is judged on its own by three rules; lines that fail go, and a
document that loses more than ``max_lost`` of its word characters is rejected:

* punctuation: the line does not end in a terminal mark, or its symbols (``#*$%&|<>``)
  outnumber half of its words, or most of its words end in ``!!``;
* navigation: at least two ``|``, ``»`` or ``›`` separators stand between its words;
* boilerplate: it holds one of a few fixed phrases of page furniture.

The document-level base figures (words, symbols, repeated lines, words in repeated
five-word windows) come from the same pass and decide ``base_failed``.

Defined cases: a null or empty text has no words, fails the base rule and has an empty
cleaned text; lines of white space are neither judged nor counted; repeated documents
each get their row; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.llm import text as X

# fixed values of the rules
TERMINAL = (".", "!", "?", "…", ":", ";", "\"", "'", "”", "’", "»", ")", "。", "！", "？")
SEPARATORS = ("|", "»", "›")
SYMBOLS = b"#*$%&|<>"
PHRASES = ("cookie policy", "privacy policy", "terms of use", "terms of service",
           "all rights reserved", "enable javascript", "skip to content", "sign in",
           "log in", "subscribe to our", "lorem ipsum", "click here")
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_LOST = 0.5
WINDOW = 5

_TERMINAL = tuple(x.encode() for x in TERMINAL)
_SEPARATORS = {x.encode() for x in SEPARATORS}
_PHRASES = tuple(x.encode() for x in PHRASES)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def line_fails(line: bytes) -> str | None:
    """The rule that a line with a word fails, or None."""
    found = line.split()
    if not line.rstrip().endswith(_TERMINAL):
        return "punctuation"
    n = len(found)
    if sum(map(line.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))) * 2 > n:
        return "navigation" if sum(w in _SEPARATORS for w in found) >= 2 else "punctuation"
    if line.count(b"!!") and sum(w.endswith(b"!!") for w in found) * 2 > n:
        return "punctuation"
    if any(x in line for x in _SEPARATORS) and sum(w in _SEPARATORS for w in found) >= 2:
        return "navigation"
    low = line.lower()
    return "boilerplate" if any(p in low for p in _PHRASES) else None


def _chars(raw: bytes) -> int:
    """Code points outside white space."""
    b = np.frombuffer(raw, np.uint8)
    return int(((b & 0xC0) != 0x80).sum() - X.SPACE[b].sum())


def judge(raw: bytes, max_lost: float = MAX_LOST) -> dict:
    """Base figures, line verdicts and the cleaned text of one document."""
    buf = np.frombuffer(raw, np.uint8)
    _, _, h = X.words(buf, X.NOT_SPACE)
    n = len(h)
    total = _chars(raw)
    repeated = 0
    if n > WINDOW:
        grams, back, counts = np.unique(X.ngram_hashes(h, WINDOW), return_inverse=True,
                                        return_counts=True)
        at = np.flatnonzero(counts[back] > 1)
        if len(at):
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + WINDOW, -1)
            repeated = int((np.cumsum(edge[:-1]) > 0).sum())
    seen, dup, lines, kept, lost, fails = set(), 0, 0, [], 0, {}
    for line in raw.split(b"\n"):
        if not line.strip():
            kept.append(line)
            continue
        lines += 1
        dup += line in seen
        seen.add(line)
        why = line_fails(line)
        if why:
            lost += _chars(line)
            fails[why] = fails.get(why, 0) + 1
        else:
            kept.append(line)
    base_failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    return {"n_words": n, "word_chars": total, "n_symbols": int(_SYMBOL[buf].sum()),
            "n_dup_lines": dup, "n_repeat_words": repeated, "base_failed": base_failed,
            "kept": not base_failed and lost <= max_lost * total,
            "n_lines": lines, "n_removed_lines": sum(fails.values()), "lost_chars": lost,
            "n_punctuation": fails.get("punctuation", 0),
            "n_navigation": fails.get("navigation", 0),
            "n_boilerplate": fails.get("boilerplate", 0),
            "cleaned": b"\n".join(kept)}


_BOOL = {"base_failed", "kept"}
_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
          "kept", "n_lines", "n_removed_lines", "lost_chars", "n_punctuation", "n_navigation",
          "n_boilerplate"]


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_lost: float = MAX_LOST, with_text: bool = True) -> DataFrame:
    """One row per document: id, figures, verdict and (``with_text``) the cleaned text."""
    frame = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    names = [*_NAMES, *(["cleaned"] if with_text else [])]
    spark_type = {n: T.BooleanType() if n in _BOOL else T.LongType() for n in _NAMES}
    arrow_type = {n: pa.bool_() if n in _BOOL else pa.int64() for n in _NAMES}
    schema = T.StructType([frame.schema.fields[0],
                           *[T.StructField(n, spark_type.get(n, T.StringType())) for n in names]])

    def run(batches):
        for batch in batches:
            cols = {n: [] for n in names}
            for raw in X.documents(batch, "__text"):
                x = judge(raw, max_lost)
                for n in names:
                    cols[n].append(x[n].decode() if n == "cleaned" else x[n])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(cols[n], arrow_type.get(n, pa.string()))
                                    for n in names]], names=schema.names)

    return frame.mapInArrow(run, schema)

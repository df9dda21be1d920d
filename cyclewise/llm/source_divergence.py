"""Source divergence audit: how far the sources of a language differ in their use of terms.

Every (language, source) group and every language gives each kept term of the language (one in at
least ``min_docs`` of its documents) a scaled share
``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``, with N the group's count over the V kept
terms. Two shares differ by ``f(p, q) = floor((p - q)^2 / (p + q))``. A pair of sources is worth
the sum of f over all kept terms; a term is worth f of the group against its language.

Most terms are absent from most sources, so a pair's sum is taken apart. With z the share of a
term that a group does not have,

    sum over terms of f(pa, pb) = V f(za, zb)
        + sum over terms of a   [f(pa, zb) - f(za, zb)]        (and the same for b)
        + sum over terms of both [f(pa, pb) - f(pa, zb) - f(za, pb) + f(za, zb)].

The second line needs only the multiplicity of each share within a source. The third comes from
a frequent-pattern tree: a term's row lists its nonzero shares in the order of the sources, equal
rows are counted once with their multiplicity, and rows that begin alike share a path. Each pair
of a node and one of its ancestors is a pair of shares that as many terms have as pass through
the node; its correction is taken once, times that number. The tree is never held: rows are
range-partitioned and sorted, so a path's rows lie side by side, the nodes of one depth are the
places where rows begin to differ, and a path that a partition or block cuts counts in parts.

All arithmetic is exact, in 64-bit integers (shares are at most SCALE + 1; decimals for the
division), so the result does not depend on the layout.

Defined cases: null text, language and source read as ''; a group without terms has pairs worth 0
if its language keeps no term, else of zero counts; ties rank by the item's UTF-8 bytes; repeated
documents count as often as they stand; other columns are ignored; an empty table gives no rows.
Memory of a task: one Arrow batch, ``HELD`` distinct terms and one block of rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclewise.llm import text as X
from cyclewise.session import reliable_checkpoint

SCALE = 1_000_000_000
MIN_DOCS = 10
TOP = 10
HELD = 1 << 18  # distinct terms counted in a task before they are sent on
BLOCK = 1 << 20  # numbers of rows that are laid out side by side at once
BROADCAST_GROUPS = 100_000  # groups up to which their sizes go to every task

# bytes of a term: A-Z (lower-cased), a-z and all of non-ASCII letters; others end it
_LETTERS = bytes(X.LOWER[i] if chr(i).isascii() and chr(i).isalpha() or i >= 0x80 else 0x20
                 for i in range(256))


def terms(raw: bytes) -> list[bytes]:
    """Matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased."""
    return raw.translate(_LETTERS).split()


def _apart(p: Column, q: Column) -> Column:
    """f: shares are at most SCALE + 1, so the square fits a long; ``div`` of longs is exact."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _share(count, n: Column, v: Column) -> Column:
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + F.lit(2)).cast("decimal(19,0)")
    size = n + 2 * v
    return F.when(size > 0, 1 + F.call_function("div", top, size.cast("decimal(19,0)"))).otherwise(F.lit(1))


_COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                        T.StructField("term", T.StringType()), T.StructField("n", T.LongType()),
                        T.StructField("docs", T.LongType())])


def _count(batches):
    """Occurrences and documents of each (language, source, term) seen by a task so far."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def rows():
        for (lang, source), (total, docs) in found.items():
            n = len(total)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n), pa.array([source] * n), pa.array([w.decode() for w in total]),
                     pa.array(total.values(), pa.int64()), pa.array([docs[w] for w in total], pa.int64())],
                    names=_COUNTS.names)

    for batch in batches:
        groups = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        for key, raw in zip(groups, X.documents(batch, "text")):
            if key not in found:
                found[key] = (Counter(), Counter())
            total, docs = found[key]
            words, before = terms(raw), len(total)
            total.update(words)
            docs.update(set(words))
            held += len(total) - before
            if held > HELD:
                yield from rows()
                found, held = {}, 0
    yield from rows()


def term_counts(frame: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents."""
    return (frame.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def tree_corrections(sources: list[np.ndarray], shares: list[np.ndarray], zeros: list[np.ndarray],
                     times: np.ndarray) -> list[tuple[int, int, int]]:
    """(source, later source, sum of corrections) of sorted rows; each row an array of source
    numbers, of shares and of shares at zero; ``times`` are the rows' multiplicities."""
    n, size = len(times), np.array([len(x) for x in sources])
    wide = int(size.max(initial=0))
    if wide < 2:
        return []
    inside = np.arange(wide) < size[:, None]
    s, p, z = (np.full((n, wide), -1, np.int64) for _ in range(3))
    for grid, values in ((s, sources), (p, shares), (z, zeros)):
        grid[inside] = np.concatenate(values)
    # where a row's path leaves that of the row before: first depth with another item
    alike = np.cumprod((s[1:] == s[:-1]) & (p[1:] == p[:-1]), axis=1).sum(axis=1)
    leaves = np.concatenate([[0], alike])
    sums: Counter = Counter()
    for depth in range(1, wide):
        rows = np.flatnonzero(size > depth)
        if not len(rows):
            break
        # rows of one node are neighbours: no row between them is shorter or leaves the path
        new = np.ones(len(rows), bool)
        near = rows[1:] == rows[:-1] + 1
        new[1:] = ~near | (leaves[rows[1:]] <= depth)
        heads = rows[new]
        through = np.add.reduceat(times[rows], np.flatnonzero(new))
        b, pb, zb = s[heads, depth], p[heads, depth], z[heads, depth]
        for up in range(depth):
            a, pa_, za = s[heads, up], p[heads, up], z[heads, up]
            value = through * (_f(pa_, pb) - _f(pa_, zb) - _f(za, pb) + _f(za, zb))
            order = np.lexsort((b, a))
            cuts = np.flatnonzero(np.append(True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)))
            first = order[cuts]
            for i, j, v in zip(a[first].tolist(), b[first].tolist(),
                               np.add.reduceat(value[order], cuts).tolist()):
                sums[i, j] += v
    return [(i, j, v) for (i, j), v in sums.items()]


def _corrections(batches):
    """Partial sums (lang, a, b, value) of the rows of a sorted partition, block by block."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        size = np.asarray(batch.column(1).value_lengths())
        at = 0
        while at < len(langs):
            # a block: one language, about BLOCK numbers when laid out side by side
            same = np.flatnonzero(langs[at:] != langs[at])
            stop = at + int(same[0]) if len(same) else len(langs)
            laid = np.maximum.accumulate(size[at:stop]) * np.arange(1, stop - at + 1)
            to = at + max(1, int(np.searchsorted(laid, BLOCK, "right")))
            part = batch.slice(at, to - at)
            flat = part.column(1).flatten()
            cut = np.cumsum(size[at:to])[:-1]
            s, p, z = (np.split(np.asarray(flat.field(k)).astype(np.int64), cut) for k in range(3))
            found = tree_corrections(s, p, z, np.asarray(part.column(2)))
            if found:
                a, b, v = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[at]] * len(a)), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                     pa.array(v, pa.int64())], names=["lang", "a", "b", "value"])
            at = to


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows against every other source of the
    language, ``term`` rows for the ``top`` terms that a group uses more than its language."""
    frame = X.pick(docs, text=text_col, lang=lang_col, source=source_col).select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    of_term = Window.partitionBy("lang", "term")
    kept = reliable_checkpoint(
        term_counts(frame)
        .select("lang", "source", "term", "n", F.sum("docs").over(of_term).alias("df"),
                F.sum("n").over(of_term).alias("total"),
                F.min("source").over(of_term).alias("least"))
        .where(F.col("df") >= min_docs)
        .select("lang", "source", "term", "n", "total", (F.col("least") == F.col("source")).alias("once")))

    # one row per group: its number among the language's sources, sizes and the share of an absent term
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count_if("once").alias("terms"))
    by_lang = Window.partitionBy("lang")
    groups = reliable_checkpoint(
        frame.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("size", F.lit(0)).alias("size"),
                F.sum(F.coalesce("terms", F.lit(0))).over(by_lang).alias("v"),
                F.sum(F.coalesce("size", F.lit(0))).over(by_lang).alias("lang_size"),
                (F.row_number().over(by_lang.orderBy("source")) - 1).alias("s"))
        .withColumn("z", _share(F.lit(0), F.col("size"), F.col("v"))))
    small = groups.count() <= BROADCAST_GROUPS
    known = F.broadcast(groups) if small else groups

    shares = kept.join(known, ["lang", "source"]).withColumn(
        "p", _share(F.col("n"), F.col("size"), F.col("v")))
    pairs = _pairs(groups, known, shares)
    found = _top_terms(shares, top)
    return pairs.unionByName(found)


def _top_terms(shares: DataFrame, top: int) -> DataFrame:
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (shares.withColumn("q", _share(F.col("total"), F.col("lang_size"), F.col("v")))
            .where(F.col("p") > F.col("q"))
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    _apart(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top))


def _pairs(groups: DataFrame, known: DataFrame, shares: DataFrame) -> DataFrame:
    other = known.select("lang", F.col("s").alias("o"), F.col("z").alias("oz"))
    ordered = (F.least("s", "o").alias("a"), F.greatest("s", "o").alias("b"))
    absent = groups.join(other, "lang").where("s < o").select(
        "lang", *ordered, (F.col("v") * _apart(F.col("z"), F.col("oz"))).alias("value"))
    # a source's terms with one share count together before they meet the other sources
    single = (shares.groupBy("lang", "s", "p", "z").agg(F.count("*").alias("times"))
              .join(other, "lang").where("s <> o")
              .select("lang", *ordered, (F.col("times") * (_apart(F.col("p"), F.col("oz"))
                                                           - _apart(F.col("z"), F.col("oz")))).alias("value")))
    rows = (shares.groupBy("lang", "term")
            .agg(F.sort_array(F.collect_list(F.struct("s", "p", "z"))).alias("row"))
            .where(F.size("row") > 1)
            .groupBy("lang", "row").agg(F.count("*").alias("times")))
    shared = (rows.repartitionByRange("lang", "row").sortWithinPartitions("lang", "row")
              .mapInArrow(_corrections, "lang string, a int, b int, value long"))
    sums = (absent.unionByName(single).unionByName(shared)
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = sums.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("s"), F.col("b").alias("o")),
        F.struct(F.col("b").alias("s"), F.col("a").alias("o")))).alias("x"), "value").select(
        "lang", "x.s", "x.o", "value")
    name = known.select("lang", "s", "source")
    item = known.select("lang", F.col("s").alias("o"), F.col("source").alias("item"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (both.join(name, ["lang", "s"]).join(item, ["lang", "o"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
            .withColumn("rank", F.row_number().over(by_value)))

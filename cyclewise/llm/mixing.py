"""Mixing sources to target weights with Pareto order sampling.

A source's target is its share of all words by weight, at most ``max_epochs`` times its own
words; what exceeds that is shared again by weight. A document's expected number of copies
is target / source words (times its own weight, if one is given, rescaled to keep the
source's mean). Its whole copies are certain. The fractional rest is its inclusion
probability p: the documents of a source are ranked by the ratio of their random odds
u/(1-u) to their inclusion odds p/(1-p), and taken in that order until the words taken come
nearest to the words the target still lacks, which fixes the sample's size.

u comes from an MD5 of seed, id and text, so reruns and recomputed tasks agree. No task
ranks a source: words are summed per (source, bucket of the rank), the cut falls into one
bucket, and only that bucket is put in order, by a few numbers per row. Its last row taken is
the source's edge, with which every row is judged where it is read: no text is dealt out.

Defined cases: a null text has no words and size 0; a null source is a source of its own and
comes last; sources without words have target 0; an empty table gives an empty result;
equal rows are interchangeable; columns named like an output column, in any case, are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cyclewise.llm.text import word_count
from cyclewise.session import reliable_checkpoint

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKETS = 4096
SEED = 17
BROADCAST_SOURCES = 100_000  # sources up to which their figures go to every task
MADE = {"size", "source_size", "target", "copies"}


def source_targets(sized: DataFrame, source: str = "source", size: str = "size",
                   weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: __source, source_size, target.

    The windows below run over one row per source. With sources in the order of cap per
    weight, the first that fits under its cap fixes the level all later ones get."""
    per = sized.groupBy(F.col(f"`{source}`").alias("__source")).agg(
        F.sum(F.col(f"`{size}`")).alias("source_size"))
    by_name = Window.orderBy(F.col("__source").asc_nulls_last())
    choice = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
                          .cast("int"))
    per = per.withColumn("__w", choice).withColumn("__cap", F.col("source_size") * max_epochs)
    by_cap = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("__source").asc_nulls_last())
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    later = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding,
                                                  Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything)
              - F.coalesce(F.sum("__cap").over(earlier), F.lit(0))) / F.sum("__w").over(later))
    per = per.withColumn("__level", level)
    # the first source whose cap is not reached at its level fixes it for all
    per = per.withColumn("__fits", F.min(F.when(F.col("__cap") >= F.col("__w") * F.col("__level"),
                                                F.struct(F.col("__cap") / F.col("__w"),
                                                         F.col("__level").alias("level"))))
                         .over(everything)["level"])
    target = F.least(F.col("__cap").cast("double"),
                     F.coalesce(F.col("__w") * F.col("__fits"), F.col("__cap").cast("double")))
    return per.select("__source", "source_size", target.alias("target"))


def _uniform(key: Column, text: Column, seed: int) -> Column:
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("")),
                               F.coalesce(text.cast("string"), F.lit(""))).cast("binary"))
    head = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double")
    return (head + F.lit(0.5)) / F.lit(float(1 << 48))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weight_col: str | None = None,
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        buckets: int = BUCKETS, keep: list[str] | None = None,
        broadcast_sources: int | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` plus size, source_size, target and copies."""
    names = docs.columns if keep is None else keep
    kept = [(f"_{docs.columns.index(c)}", c) for c in names if c.lower() not in MADE]
    plain = docs.toDF(*[f"_{k}" for k in range(len(docs.columns))])
    at = {n: F.col(f"_{docs.columns.index(c)}") for n, c in
          (("id", id_col), ("text", text_col), ("source", source_col))}
    w = F.lit(1.0) if weight_col is None else F.greatest(F.coalesce(
        F.col(f"_{docs.columns.index(weight_col)}").cast("double"), F.lit(0.0)), F.lit(0.0))
    thin = [at["source"].alias("__of"), F.coalesce(at["id"].cast("string"), F.lit("")).alias("__id"),
            word_count(at["text"].cast("string")).alias("size"), w.alias("__weight"),
            _uniform(at["id"], at["text"], seed).alias("__u")]
    # what decides is a few numbers per row: texts are read again, but never dealt out
    light = reliable_checkpoint(plain.select(*thin))
    targets = source_targets(light, "__of", "size", weights, max_epochs)
    if weight_col is not None:
        scale = light.groupBy("__of").agg(F.sum(F.col("size") * F.col("__weight")).alias("__ws"))
        targets = targets.join(scale, F.col("__source").eqNullSafe(F.col("__of"))).drop("__of")
    else:
        targets = targets.withColumn("__ws", F.col("source_size").cast("double"))
    expected = F.when(F.col("__ws") > 0, F.least(F.lit(float(max_epochs)), F.col("__weight")
                                                 * F.col("target") / F.col("__ws"))).otherwise(0.0)

    def ranked(frame: DataFrame) -> DataFrame:
        frame = frame.withColumn("__e", expected)
        frame = frame.withColumn("__whole", F.floor("__e")).withColumn(
            "__p", F.col("__e") - F.col("__whole"))
        odds = F.col("__u") / (1 - F.col("__u"))
        rank = F.when(F.col("__p") > 0, odds * (1 - F.col("__p")) / F.col("__p"))
        frame = frame.withColumn("__q", rank)
        # q / (1 + q) spreads the ranks over the buckets, most evenly where the cut falls
        return frame.withColumn("__bucket", F.least(F.lit(buckets - 1), F.floor(
            F.lit(buckets) * F.col("__q") / (1 + F.col("__q"))).cast("int")))

    limit = BROADCAST_SOURCES if broadcast_sources is None else broadcast_sources

    def known(per_source: DataFrame) -> DataFrame:
        """One row per source, sent to every task where a count finds it small."""
        per_source = reliable_checkpoint(per_source)
        return F.broadcast(per_source) if per_source.count() <= limit else per_source

    on = F.col("__of").eqNullSafe(F.col("__source"))
    targets = known(targets)
    sums = (ranked(light.join(targets, on)).groupBy("__source", "__bucket", "target")
            .agg(F.sum(F.when(F.col("__p") > 0, F.col("size")).otherwise(0)).alias("__words"),
                 F.sum(F.col("size") * F.col("__whole")).alias("__certain")))
    along = Window.partitionBy("__source").orderBy(F.col("__bucket").asc_nulls_last())
    total = Window.partitionBy("__source")
    sums = sums.withColumn("__before", F.sum("__words").over(along) - F.col("__words"))
    sums = sums.withColumn("__lack", F.col("target") - F.sum("__certain").over(total))
    cut = sums.where((F.col("__before") < F.col("__lack")) & F.col("__bucket").isNotNull()
                     & (F.col("__words") > 0))
    cut = cut.groupBy(F.col("__source").alias("__s")).agg(
        F.max(F.struct(F.col("__bucket").alias("b"), F.col("__before").alias("before"),
                       F.col("__lack").alias("lack"))).alias("__cut"))
    plan = known(targets.join(cut, F.col("__source").eqNullSafe(F.col("__s")), "left").drop("__s"))
    # the cut's own bucket is put in order; the last row taken there is the source's edge
    key = F.struct("__q", "__id", "size")
    order = Window.partitionBy("__of").orderBy("__q", "__id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    last = (ranked(light.join(plan, on)).where(F.col("__bucket") == F.col("__cut.b"))
            .select("__of", key.alias("__key"), (
                2 * (F.col("__cut.before") + F.sum("size").over(order)) - F.col("size")
                <= 2 * F.col("__cut.lack")).alias("__nearer")))
    edge = last.groupBy(F.col("__of").alias("__s"), "__key").agg(
        F.count_if("__nearer").alias("__some"), F.count(F.lit(1)).alias("__all")).where("__some > 0").groupBy(
        "__s").agg(F.max(F.struct("__key", "__some", "__all")).alias("__edge"))
    plan = known(plan.join(edge, F.col("__source").eqNullSafe(F.col("__s")), "left").drop("__s"))
    rows = ranked(plain.select(*[F.col(a) for a, _ in kept], *thin).join(plan, on))
    in_cut = (F.col("__bucket") == F.col("__cut.b")) & F.col("__edge").isNotNull()
    chosen = (F.col("__bucket") < F.col("__cut.b")) | (in_cut & (key <= F.col("__edge.__key")))
    part = in_cut & (key == F.col("__edge.__key")) & (F.col("__edge.__some") < F.col("__edge.__all"))
    if plan.where("__edge.__some < __edge.__all").isEmpty():
        rows = rows.withColumn("__in", chosen)
    else:  # equal rows of which an edge takes some: they alone are numbered
        number = F.row_number().over(Window.partitionBy("__of").orderBy("__q"))
        tied = F.coalesce(part, F.lit(False))
        rows = rows.where(~tied).withColumn("__in", chosen).unionByName(
            rows.where(tied).withColumn("__in", number <= F.col("__edge.__some")))
    copies = (F.col("__whole") + F.when(F.col("__in") & (F.col("__p") > 0), 1).otherwise(0)).cast("long")
    return rows.select(*[F.col(a).alias(c) for a, c in kept], "size", "source_size", "target",
                       copies.alias("copies"))


def expand(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row per copy, with ``columns`` only."""
    return mixed.where(F.col("copies") > 0).select(
        *[F.col(f"`{c}`") for c in columns],
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy")).drop("__copy")

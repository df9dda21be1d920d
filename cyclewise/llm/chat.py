"""Chat formatting by perspective rotation.

For every participant of a conversation the dialogue is rendered once with that speaker as
``assistant`` and every other speaker as a ``user`` with a name; system turns stay system
turns in every rendering and are nobody's perspective. A rendered turn is

    <|assistant|>\\n{text}<|end|>\\n        the perspective's own turns
    <|user name={speaker}|>\\n{text}<|end|>\\n
    <|system|>\\n{text}<|end|>\\n

and the loss mask covers the text and end mark of the perspective's own turns only. The
result has a row per conversation, perspective and turn with the turn's character offsets
in that rendering, so no task has to hold a rendering; ``render`` joins them to texts where
conversations are known to fit.

Offsets are running sums in blocks: turns are summed per (conversation, perspective, block),
the block sums become block offsets, and only a block's turns are ordered together. A turn's
block comes from its number, so a conversation with a third of all turns is spread as well.

Defined cases: a null text is empty; a null or empty speaker is the participant ``unknown``;
turns with equal numbers are ordered by speaker and text, equal turns are kept and are
interchangeable; a null turn number stands last; null conversation ids are one conversation;
conversations of system turns only have no perspectives; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SYSTEM = "system"
UNKNOWN = "unknown"
END = "<|end|>\n"
BLOCK = 4096  # turn numbers per block


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           speaker_col: str = "role", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """conv, perspective, turn, speaker, role, rendered, start, end, mask_start, mask_end.

    Offsets count characters of the perspective's rendering; an unmasked turn has an empty
    mask at its end."""
    speaker = F.col(f"`{speaker_col}`").cast("string")
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("__conv"), F.col(f"`{turn_col}`").alias("__turn"),
        F.when(F.coalesce(speaker, F.lit("")) == "", F.lit(UNKNOWN)).otherwise(speaker).alias("speaker"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"))
    people = rows.where(F.col("speaker") != SYSTEM).select(
        F.col("__conv").alias("__c"), F.col("speaker").alias("perspective")).distinct()
    rows = rows.join(people, F.col("__conv").eqNullSafe(F.col("__c"))).drop("__c")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    head = F.when(F.col("speaker") == SYSTEM, "<|system|>\n").when(own, "<|assistant|>\n").otherwise(
        F.concat(F.lit("<|user name="), "speaker", F.lit("|>\n")))
    rows = rows.select("__conv", "perspective", "__turn", "speaker", role.alias("role"),
                       F.length(head).alias("__head"), own.alias("__own"),
                       F.concat(head, "__text", F.lit(END)).alias("rendered"))
    rows = rows.withColumn("__len", F.length("rendered").cast("long"))
    # null turns go to the last block
    rows = rows.withColumn("__block", F.coalesce(
        F.floor(F.col("__turn") / F.lit(block)), F.lit((1 << 62))))
    key = [F.col("__conv"), F.col("perspective")]
    sums = rows.groupBy(*key, "__block").agg(F.sum("__len").alias("__sum"))
    before = Window.partitionBy(*key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("__conv").alias("__c"), F.col("perspective").alias("__p"),
                       F.col("__block").alias("__b"),
                       F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    rows = rows.join(sums, F.col("__conv").eqNullSafe(F.col("__c"))
                     & (F.col("perspective") == F.col("__p")) & (F.col("__block") == F.col("__b")))
    inside = Window.partitionBy(*key, "__block").orderBy(
        F.col("__turn").asc_nulls_last(), "speaker", "rendered").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.col("__offset") + F.sum("__len").over(inside))
    rows = rows.withColumn("start", F.col("end") - F.col("__len"))
    return rows.select(
        F.col("__conv").alias(conv_col), "perspective", F.col("__turn").alias(turn_col), "speaker",
        "role", "rendered", "start", "end",
        F.when(F.col("__own"), F.col("start") + F.col("__head")).otherwise(F.col("end")).alias("mask_start"),
        F.when(F.col("__own"), F.col("end") - 1).otherwise(F.col("end")).alias("mask_end"))


def render(rotated: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One text per (conversation, perspective) with its masked spans, for conversations of
    ordinary length: each rendering is gathered in one row."""
    turns = F.sort_array(F.collect_list(F.struct("start", "rendered", "mask_start", "mask_end")))
    got = rotated.groupBy(F.col(f"`{conv_col}`"), "perspective").agg(turns.alias("t"))
    masked = F.filter("t", lambda x: x["mask_start"] < x["mask_end"])
    return got.select(conv_col, "perspective", F.array_join("t.rendered", "").alias("text"),
                      F.transform(masked, lambda x: F.struct(x["mask_start"].alias("start"),
                                                             x["mask_end"].alias("end"))).alias("mask"))

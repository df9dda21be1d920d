"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.llm import (chat, decontaminate, licenses, mixing, ngram_join, periodic_runs, pii,
                           quality_classifier, quality_rules, secrets, shard, source_divergence,
                           suffix_dedup)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP1_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS k, conv_id, turn,
         CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE role END AS speaker,
         coalesce(text, '') AS text
  FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (
  SELECT t.*, p.perspective,
         CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
              ELSE 'user' END AS role,
         CASE WHEN speaker = 'system' THEN '<|system|>' || chr(10)
              WHEN speaker = perspective THEN '<|assistant|>' || chr(10)
              ELSE '<|user name=' || speaker || '|>' || chr(10) END AS head
  FROM t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
w AS (SELECT *, head || text || '<|end|>' || chr(10) AS rendered FROM r),
o AS (
  SELECT *, sum(length(rendered)) OVER (PARTITION BY conv_id, perspective
           ORDER BY turn NULLS LAST, speaker, rendered ROWS UNBOUNDED PRECEDING) AS e
  FROM w)
SELECT conv_id, perspective, turn, speaker, role, sha256(rendered) AS rendered_sha256,
       (e - length(rendered))::BIGINT AS start, e::BIGINT AS "end",
       (CASE WHEN role = 'assistant' THEN e - length(rendered) + length(head) ELSE e END)::BIGINT AS mask_start,
       (CASE WHEN role = 'assistant' THEN e - 1 ELSE e END)::BIGINT AS mask_end
FROM o
"""


@query("op1_chat_rotation", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.rotate(table(spark, sf_dir, "conversations"))
    return turns.select("conv_id", "perspective", "turn", "speaker", "role",
                        F.sha2(F.col("rendered").cast("binary"), 256).alias("rendered_sha256"),
                        "start", "end", "mask_start", "mask_end")


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    spans = F.transform("licenses", lambda x: F.concat_ws(
        ":", x["license"], x["start"].cast("string"), x["end"].cast("string"),
        F.round(x["coverage"] * 1000).cast("int").cast("string")))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"),
                        F.array_join(F.array_sort(F.array_distinct(F.transform(
                            "licenses", lambda x: x["license"]))), ",").alias("license_ids"),
                        F.array_join(spans, ",").alias("spans"))


@query("op3_secrets")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.filter("secrets", lambda x: x["kind"].isin(*secrets.BASE_KINDS))
    return found.select("doc_id", count("assign").alias("n_assign"),
                        count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("secrets")).alias("spans"))


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = quality_classifier.classify(docs, labels, keep=["doc_id"])
    return out.select("doc_id", (~quality_classifier.learnable(F.col("doc_id"))).alias("held_out"),
                      "score", "predicted")


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         (('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|'
                              || coalesce(text, '')), 1, 12))::BIGINT + 0.5::DOUBLE)
         / 281474976710656::DOUBLE AS u
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 3 * source_size AS cap,
         ((sum(source_size) OVER ())
          - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(w) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM per),
targets AS (
  SELECT source, source_size,
         least(cap::DOUBLE, coalesce(w * (SELECT level FROM levels WHERE cap >= w * level
               ORDER BY cap / w, level LIMIT 1), cap::DOUBLE)) AS target
  FROM levels),
joined AS (
  SELECT s.doc_id, s.source, s.size, s.u, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(3.0::DOUBLE, t.target / t.source_size) ELSE 0 END AS e
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, floor(e) AS whole, e - floor(e) AS p,
         CASE WHEN e - floor(e) > 0 THEN u / (1 - u) * (1 - (e - floor(e))) / (e - floor(e)) END AS q
  FROM joined),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, size
                            ROWS UNBOUNDED PRECEDING) AS after,
         target - sum(size * whole) OVER (PARTITION BY source) AS lack
  FROM ranked)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN p > 0 AND 2 * after - size <= 2 * lack THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""


@query("op6_mix", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


@query("op7_ngram_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, sf_dir, "documents"), count_links=False).select(
        "doc_id", "n_shingles", "component_id", "class_id")


OP8_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
iw AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
wins AS (
  SELECT DISTINCT item, least(10, len(w)) AS n,
         array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM iw, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM wins),
pos AS (
  SELECT k, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM dw, sizes, unnest(range(1, len(w) - n + 2)) AS r(i) WHERE len(w) >= n),
hits AS (SELECT p.k, p.i, p.n, s.item FROM pos p JOIN wins s ON p.n = s.n AND p.win = s.win),
hit_words AS (
  SELECT k, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS r(j) GROUP BY k),
hit_items AS (
  SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT k, item FROM hits) GROUP BY k)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(t.n_items, 0)::BIGINT AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hit_words h ON d.k = h.k LEFT JOIN hit_items t ON d.k = t.k
"""


@query("op8_decontaminate", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.scan_benchmark(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                       table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.clean_lines(table(spark, sf_dir, "documents"), with_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_removed_lines", "n_punctuation", "n_navigation",
        "n_boilerplate")


@query("op10_shard")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", shard.document_size().alias("size"), shard.text_crc32().alias("text_crc32"),
        F.lit("key").alias("law"))
    return shard.shard_documents(rows).select("doc_id", "size", "text_crc32", "law", "shard",
                                              "slot", "grown_shard")


@query("op11_pii")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans, kind):
        return F.transform(spans, lambda x: F.concat_ws(
            ":", kind(x), x["start"].cast("string"), x["end"].cast("string")))

    base = joined("base", lambda x: x["kind"])
    terms = joined("terms", lambda x: F.lit("term"))
    return found.select("doc_id", *[count(k) for k in pii.KINDS],
                        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.concat(base, terms), ",").alias("spans"),
                        F.size("terms").cast("long").alias("n_terms"),
                        F.size(F.filter("terms", lambda x: x["removed"])).cast("long").alias("n_removed"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS t
  FROM documents),
w AS (
  SELECT k, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
per AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT k) AS docs FROM w GROUP BY ALL),
kept AS (
  SELECT lang, term, sum(n) AS total FROM per GROUP BY lang, term HAVING sum(docs) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(total) AS size FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
sizes AS (
  SELECT p.lang, p.source, sum(p.n) AS size FROM per p JOIN kept USING (lang, term) GROUP BY ALL),
share AS (
  SELECT g.lang, g.source, k.term, coalesce(p.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(p.n, 0) + 2) // (coalesce(s.size, 0) + 2 * l.v) AS p,
         1 + 1000000000::HUGEINT * (k.total + 2) // (l.size + 2 * l.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN sizes s ON g.lang = s.lang AND g.source = s.source
  LEFT JOIN per p ON g.lang = p.lang AND g.source = p.source AND k.term = p.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM share WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 10
"""


@query("op12_source_divergence", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.find_runs(table(spark, sf_dir, "documents"), tails=True, with_text=False)

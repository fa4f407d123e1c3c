"""The operators as queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat_format,
    decontaminate,
    hard_negatives,
    html_extract,
    licenses,
    lm_scoring,
    mixing,
    near_dup,
    periodic_runs,
    quality_classifier,
    quality_rules,
    toxicity,
    url_filter,
)
from tidemark.llm.base import WORD, fold, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digested(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), p AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS pattern
  FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i) WHERE len(w) > 0
), lens AS (SELECT DISTINCT n FROM p
), windows AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS pattern
  FROM d, lens, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) WHERE len(w) >= n
), found AS (SELECT DISTINCT r, i, n, pattern FROM windows SEMI JOIN p USING (n, pattern)
), hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM found) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found JOIN p USING (n, pattern) WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scanned(docs, licenses.learned(docs))
    families = F.array_join(F.array_sort(F.array_distinct("notices.family")), ",")
    return found.select("doc_id", "n_paragraphs", F.size("notices").cast("long").alias("n_notices"), families.alias("families"), F.array_max("notices.probability").alias("probability"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "probability")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def _scored(docs: DataFrame, score, threshold: float) -> DataFrame:
    scored = docs.select("doc_id", (fold("doc_id") == 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.learned(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, quality_classifier.score_column(docs, model), 0.3)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    return _scored(docs, toxicity.score_column(docs, model), 0.5)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "position")


#: The level of the targets is found in closed form: sources in order of the level at which they are full.
OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS digest
  FROM documents
), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s
), w AS (SELECT *, (CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight, (source_size * 2)::DOUBLE AS cap FROM r
), f AS (
  SELECT *, cap / weight AS full_at,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         sum(source_size) OVER () * 150 / 100.0::DOUBLE AS wanted
  FROM w
), l AS (SELECT coalesce(arg_min((wanted - used) / open_weight, full_at) FILTER (full_at >= (wanted - used) / open_weight), 0) AS level FROM f
), t AS (SELECT source, source_size, place, least(weight * level, cap) AS target FROM w, l
), c AS (
  SELECT doc_id, size, source_size, place, target, (CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END) AS passes,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, (passes * size + greatest(0, least(size, floor(target)::BIGINT - passes * source_size - before)))::BIGINT AS taken,
         least(before / greatest(target, 1.0::DOUBLE), 1.0::DOUBLE) AS share,
         CASE place % 3 WHEN 0 THEN 1.5 WHEN 1 THEN 1.0 ELSE 0.5 END::DOUBLE AS w0, CASE place % 3 WHEN 0 THEN -1 WHEN 1 THEN 0 ELSE 1 END::DOUBLE AS slope
  FROM c
)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken > 0 THEN floor(least(CASE WHEN share <= 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * share / (w0 + sqrt(greatest(w0 * w0 + 2 * slope * share, 0))) END, 1) * 1000000000)::BIGINT END AS position
FROM k
"""


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.judged(docs).drop("text", "lang")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("id")
    planted = spark.range(2).select(
        F.lit(-7).alias("conv_id"), turn.alias("turn"), F.when(turn == 0, "user").otherwise("assistant").alias("role"), F.lit(r"\### Assistant: </turn> ok").alias("text")
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(planted)
    return chat_format.digested(chat_format.formatted(rows))


OP11_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'
), t AS (
  SELECT *, len('### ') + len(role) + len(regexp_extract_all(role, '[\\:#<\n]')) + len(': ') + len(text)
            + len(regexp_extract_all(text, '#{3,}|</turn>')) + len(E'\n</turn>\n') AS formatted
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(formatted)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


def planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text with the contract's period: from word a on, p words repeat in the documents that their id's hash picks."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    found = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    # a one-row explode, so that the words of a text are found once
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.explode(F.array(found)).alias("words"))
    rows = rows.withColumn("n", F.coalesce(F.size("words"), F.lit(0)).cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    left = F.col("n") - F.col("a")
    rows = rows.withColumn("p", (1 + F.floor(left / (3 + F.col("g") % 8))).cast("int"))
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(period, F.ceil(left / F.col("p")).cast("int"))), 1, left.cast("int"))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted_runs(table(spark, sf_dir, "documents"))
    found = periodic_runs.detected(docs).select("doc_id", "runs", "collapsed", periodic_runs.longest(F.col("runs")).alias("longest"))
    length = -F.col("longest.short")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), length.alias("length"), F.col("longest.period").alias("period"),
        F.floor(1000 * length / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(periodic_runs.listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mined(rows, vec_id % 50 == 0)


OP13_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), p AS (
  SELECT a.uid AS anchor, a.vec_id AS anchor_id, x.uid, x.vec_id, x.label = a.label AS same, list_inner_product(a.q, x.q)::BIGINT AS score
  FROM e a JOIN e x ON a.uid <> x.uid AND len(a.q) = len(x.q) WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, uid) AS place FROM p WHERE same QUALIFY place <= 5
)
SELECT s.anchor_id, s.vec_id AS positive_id, row_number() OVER (PARTITION BY s.anchor, s.place ORDER BY n.score DESC, n.vec_id NULLS LAST, n.uid)::INT AS rank,
       n.vec_id AS negative_id, s.score AS positive_score, n.score AS negative_score, s.place::INT AS positive_rank
FROM positives s JOIN p n ON n.anchor = s.anchor AND NOT n.same AND 50 * s.score <= 100 * n.score AND 100 * n.score <= 95 * s.score
QUALIFY rank <= 3
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_license_scan": op2_license_scan,
    "op3_url_filter": op3_url_filter,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_html_extraction": op5_html_extraction,
    "op6_toxicity": op6_toxicity,
    "op7_source_mixing": op7_source_mixing,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_quality_rules": op9_quality_rules,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_chat_formatting": op11_chat_formatting,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL = {"op1_decontamination": OP1_SQL, "op7_source_mixing": OP7_SQL, "op11_chat_formatting": OP11_SQL, "op13_hard_negatives": OP13_SQL}

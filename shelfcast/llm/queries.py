"""The dealt operators on their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm import (
    decontaminate, hard_negatives, license_scan, line_dedup, lm_score, mixing, near_dedup, quality, sharding, token_alignment, token_count,
    token_output, topk_search,
)
from shelfcast.llm.license_rules import RULES, SPAN
from shelfcast.session import scratch_path


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score_documents(spark, _table(spark, folder, "documents"))


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(spark, _table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(spark, _table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, _table(spark, folder, "documents"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.fuzzy_lines(spark, _table(spark, folder, "documents"))


def op6_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return token_output.write_training_order(
        spark, _table(spark, folder, "documents"), scratch_path(spark, "token-output"))


def op7_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk_search.whole_vectors(_table(spark, folder, "embeddings"))
    return topk_search.top_k(spark, vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(spark, _table(spark, folder, "documents"))


def op9_token_count(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.count_tokens(spark, _table(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.draw(spark, _table(spark, folder, "documents"))


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_report(_table(spark, folder, "documents"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    rows = _table(spark, folder, "embeddings").filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(~odd)
    return hard_negatives.mine(spark, rows.select(
        vec_id.alias("vec_id"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("parts"),
        (vec_id % 50 == 0).alias("anchor")))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align_tokens(spark, _table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality": op3_quality,
    "op4_near_dedup": op4_near_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_output": op6_token_output,
    "op7_topk_search": op7_topk_search,
    "op8_sharding": op8_sharding,
    "op9_token_count": op9_token_count,
    "op10_mixing": op10_mixing,
    "op11_license_scan": op11_license_scan,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_alignment": op13_token_alignment,
}

# Top-k by brute force; the list functions of the oracle's engine do the integer products.
_TOP_K = """
WITH v AS (
  SELECT DISTINCT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS parts
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.parts, c.parts)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.parts) = len(c.parts)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
) WHERE rank <= 5
"""


_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS parts
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, a.vec_id <> c.vec_id AS other,
    CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.parts, c.parts)]) AS BIGINT) AS score
  FROM v a JOIN v c ON len(a.parts) = len(c.parts)
  WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike AND other
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def _license_sql() -> str:
    """Every place of a gate word, joined with the rules of that word; containment by a self-join within a row."""
    rules = ",\n".join(f"({r.rule}, '{r.label}', '{r.gate}', ' {r.pattern} ', {r.priority}, {r.confidence}, {r.base})"
                       for r in RULES)
    return f"""
WITH rules(rule, label, gate, pattern, priority, confidence, base) AS (VALUES {rules}
), d AS (
  SELECT row_number() OVER () AS line, doc_id, [w FOR w IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w <> ''] AS words
  FROM documents
), p AS (
  SELECT line, words, unnest(words) AS gate, unnest(range(len(words))) AS place FROM d
), m AS (
  SELECT line, place, rules.*, regexp_extract(
    concat(' ', array_to_string(words[greatest(place + 1 - {SPAN}, 1):place], ' '), CASE WHEN place > 0 THEN ' ' ELSE '' END, '<', array_to_string(words[place + 1:place + {SPAN}], ' '), ' '), pattern) AS found
  FROM p JOIN rules USING (gate)
), f AS (
  SELECT *, place - (len(split_part(found, '<', 1)) - len(replace(split_part(found, '<', 1), ' ', ''))) + 1 AS begins,
    len(found) - len(replace(found, ' ', '')) - 1 AS n
  FROM m WHERE found <> ''
), k AS (
  SELECT f.*, NOT EXISTS (
    SELECT 1 FROM f g WHERE g.line = f.line AND g.begins <= f.begins AND g.begins + g.n >= f.begins + f.n
      AND (g.priority, -g.n, g.rule) < (f.priority, -f.n, f.rule)) AS kept
  FROM f
), a AS (
  SELECT line, count(*) FILTER (base) AS n_base, min(begins) FILTER (base) AS first_word, max(begins) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR kept) AS labels,
    max(confidence) FILTER (kept) AS score
  FROM k GROUP BY line
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN a USING (line)
"""


ORACLES: dict[str, str] = {"op7_topk_search": _TOP_K, "op11_license_scan": _license_sql(),
                           "op12_hard_negatives": _NEGATIVES}

"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agora.llm import (
    byte_dedup, divergence, fingerprints, lm_score, mixing, near_dups, passages, periods, pieces, pii, quality,
    token_count, toxicity,
)
from agora.llm.common import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document so that every source comes near its target."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@register
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed word rules and the likelihood-ratio verdict for every document."""
    d = quality.judged(documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio"
    )


@register
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii.report(pii.find(documents(spark, sf_dir).select("doc_id", "text")))


@register
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.report(documents(spark, sf_dir))


@register
def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that repeated 35-word windows cover."""
    return passages.removed(documents(spark, sf_dir))


@register
def op8_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier."""
    return byte_dedup.removed(documents(spark, sf_dir))


@register
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.scored(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@register
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_dups.near_duplicates(documents(spark, sf_dir))


@register
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as piece ids with merge-dropout, decoded again and compared."""
    return pieces.round_trip(documents(spark, sf_dir))


@register
def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base score and attention-model score of every document."""
    return lm_score.scored(documents(spark, sf_dir))


@register
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every pair of a language's sources, and each one's leading terms."""
    return divergence.audit(documents(spark, sf_dir))


ORACLE["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), words AS (
  SELECT row_no, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS word FROM d
), found AS (
  SELECT row_no, lang, source, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM words
), kept AS (
  SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT row_no) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), sizes AS (
  SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source
), groups AS (
  SELECT DISTINCT lang, source FROM d
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (coalesce(s.total, 0) + l.v) AS p,
    1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN sizes s USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@register
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under a public tokenizer."""
    return token_count.counted(documents(spark, sf_dir))


@register
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, some of them planted."""
    return periods.report(documents(spark, sf_dir))

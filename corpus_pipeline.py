"""A corpus pipeline over ``documents``: rules, near-dedup, masking, mixing, piece ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet in the shared scratch folder and read again as the next stage's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agora.llm import mixing, near_dups, pieces, pii, quality
from agora.llm.common import documents, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return near_dups.kept_documents(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the source mix takes it, its copies numbered."""
    return mixing.mix_documents(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each row, with merge-dropout (doc_id, source, ids, n_ids, lossless)."""
    return pieces.round_trip(docs, keep=["source"], copy="copy")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("personal data", mask_personal_data),
    ("source mix", mix_sources),
    ("piece ids", piece_ids),
]

# hashing, sketches and tokenizers have no SQL form: tested against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{k}")
    return docs

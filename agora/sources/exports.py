"""Readers for posts and comments exported from the original document store.

Existing collections (exported as JSON lines) use the stored key layout, which
differs from the declared config lists: prefixed names, one key with a literal
dot in it, and in the comment collection a field named ``author_id`` that holds
the *comment* id while ``author_author`` holds the user name.  These readers
map that layout onto the POSTS / COMMENTS schemas, so the ingest, staging and
report jobs run on existing data unchanged.  Missing keys read as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from agora.schemas import COMMENTS, POSTS

# Stored key -> our field, posts (fixed values: the stored document layout).
POST_KEYS = {
    "submission_title": "title",
    "submission_id": "post_id",
    "submission_subreddit_id": "subreddit_id",
    "submission_created": "created",
    "submission_banned_at_utc": "banned_at_utc",
    "submission_distinguished": "distinguished",
    "submission_url": "url",
    "submission_num_comments": "num_comments",
    "submission_ups": "ups",
    "submission_downs": "downs",
    "submission_over_18": "over_18",
    "submission_removal_reason": "removal_reason",
    "submission_num_reports": "num_reports",
    "submission_subreddit_type": "subreddit_type",
    "submission_author_name": "author_name",
    "submission.author_id": "author_id",
    "submission_author_link_karma": "author_link_karma",
    "submission_flair": "flair",
    "etl_ts": "etl_ts",
    "subreddit": "subreddit",
}

# Stored key -> our field, comments (fixed values: the stored document layout).
COMMENT_KEYS = {
    "author_id": "comment_id",
    "author_author": "author_name",
    "author_score": "score",
    "author_created_utc": "created_utc",
    "author_is_submitter": "is_submitter",
    "author_distinguished": "distinguished",
    "author_edited": "edited",
    "author_replies": "replies",
    "etl_ts": "etl_ts",
    "subreddit": "subreddit",
}


def _export_schema(keys: dict[str, str], target: StructType) -> StructType:
    types = {f.name: f.dataType for f in target.fields}
    return StructType([StructField(stored, types[ours], True) for stored, ours in keys.items()])


def _read(spark: SparkSession, path: str, keys: dict[str, str], target: StructType) -> DataFrame:
    raw = spark.read.schema(_export_schema(keys, target)).option("mode", "PERMISSIVE").json(path)
    # Backticks keep the dotted key a single column name instead of a struct path.
    renamed = raw.select(*[F.col(f"`{stored}`").alias(ours) for stored, ours in keys.items()])
    return renamed.select(
        *[(F.col(f.name) if f.name in keys.values() else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields]
    )


def read_post_export(spark: SparkSession, path: str) -> DataFrame:
    """Exported posts in the stored layout -> POSTS columns."""
    return _read(spark, path, POST_KEYS, POSTS)


def read_comment_export(spark: SparkSession, path: str) -> DataFrame:
    """Exported comments in the stored layout -> COMMENTS columns (no post or parent id is stored)."""
    return _read(spark, path, COMMENT_KEYS, COMMENTS)

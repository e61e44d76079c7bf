"""Declared schemas of every dataset the jobs read or write.

Field names follow what the ingest actually stores (renamed to plain names:
``post_id``, ``comment_id``, ``author_id`` ...), not the stale config lists.
All fields are nullable: the stores drop falsy values, so any may be missing.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


COMMUNITIES = _struct(
    ("subreddit_name", StringType()),
    ("subscribers_count", DoubleType()),
)

# A landed hot-listing snapshot: one row per post and listing day.
POST_SNAPSHOT = _struct(
    ("snapshot_date", DateType()),
    ("subreddit", StringType()),
    ("hot_rank", IntegerType()),
    ("title", StringType()),
    ("post_id", StringType()),
    ("subreddit_id", StringType()),
    ("created", DoubleType()),
    ("banned_at_utc", DoubleType()),
    ("distinguished", StringType()),
    ("url", StringType()),
    ("num_comments", LongType()),
    ("ups", LongType()),
    ("downs", LongType()),
    ("over_18", BooleanType()),
    ("removal_reason", StringType()),
    ("num_reports", LongType()),
    ("subreddit_type", StringType()),
    ("author_name", StringType()),
    ("author_id", StringType()),
    ("author_link_karma", LongType()),
    ("flair", StringType()),
)

# Fields a stored post may carry (everything but listing position and the
# load columns).  A record with none of them left is dropped.
POST_FIELDS = [
    "title",
    "post_id",
    "subreddit_id",
    "created",
    "banned_at_utc",
    "distinguished",
    "url",
    "num_comments",
    "ups",
    "downs",
    "over_18",
    "removal_reason",
    "num_reports",
    "subreddit_type",
    "author_name",
    "author_id",
    "author_link_karma",
    "flair",
]

POSTS = _struct(
    *[(f.name, f.dataType) for f in POST_SNAPSHOT.fields if f.name in POST_FIELDS],
    ("etl_ts", DoubleType()),
    ("subreddit", StringType()),
)

# A landed comment snapshot, flat: one row per comment, ``parent_id`` links replies.
COMMENT_SNAPSHOT = _struct(
    ("post_id", StringType()),
    ("parent_id", StringType()),
    ("comment_id", StringType()),
    ("author_name", StringType()),
    ("score", LongType()),
    ("created_utc", DoubleType()),
    ("is_submitter", BooleanType()),
    ("distinguished", StringType()),
    ("edited", StringType()),
    ("replies", LongType()),
)

COMMENT_FIELDS = [
    "comment_id",
    "author_name",
    "score",
    "created_utc",
    "is_submitter",
    "distinguished",
    "edited",
    "replies",
]

COMMENTS = _struct(
    ("post_id", StringType()),
    ("parent_id", StringType()),
    *[(f.name, f.dataType) for f in COMMENT_SNAPSHOT.fields if f.name in COMMENT_FIELDS],
    ("etl_ts", DoubleType()),
    ("subreddit", StringType()),
)

# User-by-day staging table: the author as text ('None' when missing), load day.
STAGING = _struct(
    ("author_id", StringType()),
    ("etl_ts", DateType()),
)

# Post events on the stream, in and out (same six fields both ways).
POST_EVENT = _struct(
    ("subreddit", StringType()),
    ("thread_id", StringType()),
    ("author_id", StringType()),
    ("creation_date", StringType()),
    ("url", StringType()),
    ("is_violation", BooleanType()),
)
POST_EVENT_FIELDS = [f.name for f in POST_EVENT.fields]


# Type words of the declared config schemas -> Spark types (fixed values).
DECLARED_TYPES = {
    "varchar": StringType(),
    "float": DoubleType(),
    "int": LongType(),
    "bool": BooleanType(),
}


def declared_schema(entries: list[dict]) -> StructType:
    """StructType from a declared list of ``{name, type}`` entries (config files)."""
    fields = []
    for entry in entries:
        dtype = DECLARED_TYPES.get(str(entry["type"]).strip().lower())
        if dtype is None:
            raise ValueError(f"unknown declared type {entry['type']!r} for {entry['name']!r}")
        fields.append(StructField(str(entry["name"]), dtype, True))
    return StructType(fields)


def load_declared_schema(path: str) -> StructType:
    """Read a YAML list of ``- name: / type:`` entries into a StructType."""
    import yaml  # small config file read on the driver

    with open(path, encoding="utf-8") as fh:
        entries = yaml.safe_load(fh) or []
    return declared_schema(entries)

"""Readers for landed files: the community list (CSV), listing and comment
snapshots (JSON lines or Parquet), and connection profiles for JDBC.

All readers take an explicit schema: no inference pass over the data, and
a record that does not fit lands in ``_corrupt_record`` instead of failing the
job (PERMISSIVE mode), so bad records can be quarantined.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agora.schemas import COMMENT_SNAPSHOT, COMMUNITIES, POST_SNAPSHOT

CORRUPT_COL = "_corrupt_record"


def read_communities_csv(spark: SparkSession, path: str) -> DataFrame:
    """The community list: ``subreddit_name, subscribers_count`` from a CSV with header.

    Empty fields and the usual missing-value words read as NULL; a count that
    is not a number reads as NULL too (and sorts last in ``top_communities``).
    Columns are picked by their header names, in any order and beside others; a
    file without one of them is an error.
    """
    raw = spark.read.option("header", "true").option("mode", "PERMISSIVE").csv(path)
    missing_names = [f.name for f in COMMUNITIES.fields if f.name not in raw.columns]
    if missing_names:
        raise ValueError(f"{path}: no column {', '.join(missing_names)} in the header ({', '.join(raw.columns)})")
    count = F.trim(F.col("subscribers_count"))
    missing = count.isNull() | F.lower(count).isin("", "na", "n/a", "nan", "null", "none")
    return raw.select(
        F.col("subreddit_name"),
        F.when(missing, F.lit(None)).otherwise(count.try_cast("double")).alias("subscribers_count"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in COMMUNITIES.fields])


def _read_with_quarantine(spark: SparkSession, path: str, schema: StructType, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path).withColumn(CORRUPT_COL, F.lit(None).cast("string"))
    if fmt == "json":
        full = StructType(list(schema.fields)).add(CORRUPT_COL, "string")
        return (
            spark.read.schema(full)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL)
            .json(path)
        )
    raise ValueError(f"unknown snapshot format {fmt!r}")


def read_post_snapshots(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed hot-listing snapshots (one row per post per listing day).

    Laid out as ``.../snapshot_date=YYYY-MM-DD/...``; a filter on
    ``snapshot_date`` prunes the partitions read.  Output: POST_SNAPSHOT +
    ``_corrupt_record``.
    """
    return _read_with_quarantine(spark, path, POST_SNAPSHOT, fmt)


def read_comment_snapshots(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed flat comment snapshots (``parent_id`` links replies)."""
    return _read_with_quarantine(spark, path, COMMENT_SNAPSHOT, fmt)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good rows without the corrupt column, bad rows with their raw text)``.

    The bad rows keep every column (partition columns such as the listing day
    tell where a record came from).  Spark rejects a query on a raw JSON scan
    that reads *only* the corrupt column; reading it together with the other
    columns is allowed, so writing either output needs no cache - and each
    keeps the partition pruning of filters applied before the split.  An
    aggregate over the bad side alone (``bad.count()``) reads only the corrupt
    column and is still rejected: cache the scan first for that.
    """
    good = df.where(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)
    bad = df.where(F.col(CORRUPT_COL).isNotNull())
    return good, bad


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """Stored posts or comments (Parquet, partitioned by ``etl_date, subreddit``).

    ``mergeSchema`` lets days written with an older field list sit next to
    newer ones (fields added later read as NULL in old days); filters on
    ``etl_date`` / ``subreddit`` prune partitions.
    """
    return spark.read.option("mergeSchema", "true").parquet(path)


# JDBC option keys a connection profile may set.
PROFILE_KEYS = ("url", "user", "password", "driver")


def connection_options(spark: SparkSession, profile: str) -> dict[str, str]:
    """JDBC options of a named profile, from the Spark conf or the environment.

    Looks up ``spark.agora.jdbc.<profile>.<key>`` first, then the environment
    variable ``AGORA_JDBC_<PROFILE>_<KEY>``.  Nothing is hard-coded: secrets
    come from the job's configuration.
    """
    opts: dict[str, str] = {}
    env_prefix = f"AGORA_JDBC_{profile.upper().replace('-', '_')}_"
    for key in PROFILE_KEYS:
        value = spark.conf.get(f"spark.agora.jdbc.{profile}.{key}", None) or os.environ.get(env_prefix + key.upper())
        if value:
            opts[key] = value
    if "url" not in opts:
        raise KeyError(f"no JDBC url configured for profile {profile!r}")
    return opts

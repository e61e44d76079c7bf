"""User-by-day staging load (``dim_all_users_stg``).

Reads stored comments whose creation time falls in ``[start, end)`` and keeps
two fields: the author as text ('None' when missing) and the load day.  The
reference inserts row by row and appends on every run; here the write is one
columnar job and re-runnable.  ``publish_staging`` commits a run's rows and its
quarantine together; ``write_staging`` gives each run a plain folder of its own.
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.functions.cleaning import stringify
from agora.functions.dates import as_date, day_window, epoch_to_date
from agora.schemas import STAGING
from agora.sinks.published import Entry, publish_run, read_published


def stage_users(
    comments: DataFrame,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    user_col: str = "author_name",
    day_col: str = "etl_ts",
    created_col: str = "created_utc",
) -> DataFrame:
    """``author_id STRING, etl_ts DATE`` for comments created in ``[start, end)``.

    ``start=None`` stages every day (a backfill); ``end`` defaults to the day
    after ``start``.  ``day_col`` is the load time (parity) or the creation
    time; both are epoch seconds turned into the UTC date.
    """
    rows = comments
    if start is not None:
        rows = rows.where(day_window(created_col, as_date(start), as_date(end) if end else None))
    return rows.select(
        stringify(user_col).alias("author_id"),
        epoch_to_date(day_col).alias("etl_ts"),
    )


def write_staging(staged: DataFrame, path: str, run: str, quarantine: str | None = None) -> None:
    """Write one run's rows under ``run=<run>``, partitioned by day.

    ``run`` names the creation days that the run covers.  Rows of one load day may
    come from several runs (a comment created before midnight and loaded after it),
    so a re-run replaces all rows of its own run and no others.

    Rows with no day cannot be placed in a partition and would make the
    reference's insert fail; they go to ``quarantine``, under the same run.  No
    repartition by day: a daily load is a single day, and hashing on it would
    funnel the whole load into one writer task.
    """
    one_run = {"format": "parquet", "mode": "overwrite", "partitionOverwriteMode": "static"}
    staged.where(F.col("etl_ts").isNotNull()).write.save(f"{path}/run={run}", partitionBy="etl_ts", **one_run)
    if quarantine:
        staging_without_day(staged).write.save(f"{quarantine}/run={run}", **one_run)


def publish_staging(
    staged: DataFrame,
    path: str,
    first: dt.date | str,
    end: dt.date | str,
    run: str | None = None,
    audit: Callable[[dict[str, int]], None] | None = None,
) -> Entry:
    """Load one run over the creation days [first, end): rows and quarantine in one commit.

    Rows without a day go to the output ``rejects``, all others to ``rows``, partitioned
    by day; both become visible with the run's entry, written last.  A run over several
    days (a backfill) takes the place of the daily runs in it, a repeated run that of its
    earlier attempt, and a killed one is never seen.  ``read_staging`` reads the result.
    """
    first, end = as_date(first).isoformat(), as_date(end).isoformat()
    outputs = {"rows": staged.where(F.col("etl_ts").isNotNull()), "rejects": staging_without_day(staged)}
    return publish_run(path, run or f"{first}_{end}", first, end, outputs, {"rows": ["etl_ts"]}, audit)


def read_staging(spark: SparkSession, path: str, output: str = "rows") -> DataFrame:
    """``author_id, etl_ts`` of the published runs; a filter on ``etl_ts`` (also one through a
    calendar join) prunes day folders."""
    return read_published(spark, path, output, STAGING)


def write_staging_table(staged: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Write distinct (author, day) pairs into a table partitioned by day and bucketed by author.

    All weekly reports group by ``author_id``; on a table bucketed by it, the
    scan already delivers rows hash-partitioned by author (files of the same
    bucket from different days are read together), so the mask aggregate and
    the streak's de-duplication and window run with no exchange at all.

    The reports read only *distinct* days per author, so the table keeps one
    row per (author, day): the de-duplication is a partial aggregate (a hot
    author collapses map-side), and afterwards no author has more than one
    row per day, so no bucket can be skewed by a single user.  The pairs are
    then hash-partitioned into exactly ``buckets`` tasks - the same hash as
    the bucket id - so each task writes one file per bucket and day instead of
    tasks x buckets small files.  The first load creates the table (at
    ``path`` if given); later loads add the pairs that it does not hold yet, read
    from their own days only, so a re-run changes nothing.
    """
    pairs = staged.where(F.col("etl_ts").isNotNull()).select("author_id", "etl_ts").distinct()
    spark = staged.sparkSession
    if spark.catalog.tableExists(table):
        days = [r[0] for r in pairs.select("etl_ts").distinct().collect()]  # one row per calendar day
        held = spark.table(table).where(F.col("etl_ts").isin(days))
        new = pairs.join(held, ["author_id", "etl_ts"], "left_anti").repartition(buckets, "author_id")
        new.write.insertInto(table)
        return
    rows = pairs.repartition(buckets, "author_id")
    writer = rows.write.mode("overwrite").partitionBy("etl_ts").bucketBy(buckets, "author_id").sortBy("author_id")
    if path:
        writer = writer.option("path", path)
    writer.format("parquet").saveAsTable(table)


def staging_without_day(staged: DataFrame) -> DataFrame:
    """Rows that cannot be loaded (no day): the quarantine output."""
    return staged.where(F.col("etl_ts").isNull())


def write_staging_jdbc(staged: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append staged rows to a relational table (needs the JDBC driver on the classpath)."""
    staged.where(F.col("etl_ts").isNotNull()).write.jdbc(url, table, mode="append", properties=properties)


def read_staging_jdbc(
    spark,
    url: str,
    table: str,
    properties: dict[str, str],
    first_day: dt.date | str,
    last_day: dt.date | str,
    num_partitions: int = 64,
) -> DataFrame:
    """Read the staging table over JDBC, split into ``num_partitions`` day ranges.

    Spark issues one query per range on its own connection (``partitionColumn``
    = the load day), so no single task or connection pulls the whole table;
    rows outside ``[first_day, last_day]`` land in the first / last range.
    Not run in this repository's tests: the image has no JDBC driver.
    """
    return spark.read.jdbc(
        url,
        table,
        column="etl_ts",
        lowerBound=as_date(first_day).isoformat(),
        upperBound=as_date(last_day).isoformat(),
        numPartitions=num_partitions,
        properties=properties,
    ).select("author_id", "etl_ts")

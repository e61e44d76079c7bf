"""Runs that become visible whole: write, audit, publish.

A dataset is a folder:

    <output>/run=<run>/attempt=<id>/...   what a run wrote, for each of its outputs
    runs/...                              one JSON line for each published run

``publish_run`` writes all outputs of a run into a fresh attempt folder, checks their row
counts and appends one entry last; the entry is one small file that a single task's
commit renames into place, so rows and quarantine appear together or not at all.  A job
killed before it leaves an attempt that no reader looks at.

Readers take the entries: the newest one of each run, without runs whose days a newer
entry covers (a backfill over [first, end) takes the place of the daily runs in it).  A
run that overlaps another one's days in part is refused, as neither could stand for both.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ENTRY = "run string, attempt string, first string, end string, published_us long, rows map<string,long>"


@dataclass(frozen=True)
class Entry:
    """A published run: the days [first, end) it covers (ISO texts; empty: it covers no
    days and stands beside all others) and its row counts."""

    run: str
    attempt: str
    first: str
    end: str
    published_us: int
    rows: dict[str, int]

    def covers(self, other: Entry) -> bool:
        return bool(self.first and other.first) and self.first <= other.first and other.end <= self.end

    def overlaps(self, other: Entry) -> bool:
        return bool(self.first and other.first) and self.first < other.end and other.first < self.end

    def folder(self, path: str, output: str) -> str:
        return f"{path}/{output}/run={self.run}/attempt={self.attempt}"


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """All published entries, oldest first (one for each publication: bounded by the runs)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/runs")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    rows = spark.read.schema(ENTRY).json(f"{path}/runs").collect()
    return sorted((Entry(**r.asDict()) for r in rows), key=lambda e: (e.published_us, e.attempt))


def live(found: list[Entry]) -> list[Entry]:
    """The entries that readers take."""
    newest = {e.run: e for e in found}
    return [e for e in newest.values() if not any(o.published_us > e.published_us and o.covers(e) for o in newest.values() if o is not e)]


def refuse_partial_overlap(found: list[Entry], run: str, first: str, end: str) -> None:
    new = Entry(run, "", first, end, 0, {})
    for e in live(found):
        if e.run != run and e.overlaps(new) and not new.covers(e):
            raise ValueError(f"run {run} [{first}, {end}) covers part of run {e.run} [{e.first}, {e.end}): run that one again")


def publish_run(
    path: str,
    run: str,
    first: str,
    end: str,
    outputs: dict[str, DataFrame],
    partition_by: dict[str, list[str]] | None = None,
    audit: Callable[[dict[str, int]], None] | None = None,
) -> Entry:
    """Write ``outputs`` of a run over the days [first, end) and publish them together.

    ``audit`` gets the row counts (counted while writing) and raises to keep the run
    unpublished.  A run published again replaces its earlier attempt for readers.
    """
    path = path.rstrip("/")
    spark = next(iter(outputs.values())).sparkSession
    refuse_partial_overlap(entries(spark, path), run, first, end)
    entry = Entry(run, uuid.uuid4().hex, first, end, 0, {})
    for name, df in outputs.items():
        seen = Observation(f"{name}-{entry.attempt}")
        writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists")
        if (partition_by or {}).get(name):
            writer = writer.partitionBy(*partition_by[name])
        writer.parquet(entry.folder(path, name))
        entry.rows[name] = seen.get["n"]
    if audit:
        audit(entry.rows)
    published = max([time.time_ns() // 1000, *(e.published_us + 1 for e in entries(spark, path))])
    entry = Entry(run, entry.attempt, first, end, published, entry.rows)
    spark.createDataFrame([tuple(vars(entry).values())], ENTRY).coalesce(1).write.mode("append").json(f"{path}/runs")
    return entry


def read_published(spark: SparkSession, path: str, output: str, schema: StructType | str, days: tuple[str, str] | None = None) -> DataFrame:
    """One output of the live runs, by its declared schema (partition columns included).

    ``days``: only runs that cover some day of [first, end); no other folder is listed.
    One scan reads all folders; filters on partition columns prune in it.
    """
    path = path.rstrip("/")
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    found = [e for e in live(entries(spark, path)) if e.rows.get(output)]
    if days:
        found = [e for e in found if e.first < days[1] and days[0] < e.end]
    if not found:
        return spark.createDataFrame([], schema)
    folders = [e.folder(path, output) for e in found]
    rows = spark.read.schema(schema).option("basePath", f"{path}/{output}").parquet(*folders)
    return rows.select(*(f"`{name}`" for name in schema.names))  # without run and attempt


__all__ = ["Entry", "entries", "live", "publish_run", "read_published"]

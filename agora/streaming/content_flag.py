"""Streaming adult-content flag (Q7): post events in, flagged post events out.

source (Kafka topic from the earliest offset, or a directory of JSON lines /
Parquet files) -> ``from_json`` by the declared six-field schema -> the two
lookups and the flag rule of the batch query -> sink (Kafka topic as JSON, or a
file sink) with a checkpoint.  ``start_current_flags`` reads the lookups afresh in
every micro-batch; ``flag_events`` joins the stream with lookups fixed at its start.

Delivery: the file sink is exactly-once (its commit log lists the files of
each finished batch); the Kafka sink is at-least-once.  A lost executor just
re-runs its tasks; a lost driver restarts from the checkpoint.

Micro-batches do not run AQE, so a lookup side above the broadcast bound is
joined with a salted shuffle (``salt_buckets``) to keep a hot community or
thread from landing on a single task.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from agora.functions.json import decode_json, encode_json
from agora.plans.moderation import apply_content_flag, post_flags_from_posts
from agora.schemas import POST_EVENT, POST_EVENT_FIELDS
from agora.sources.standins import post_events_from_documents

CORRUPT_COL = "_corrupt_record"
DEFAULT_SALT_BUCKETS = 16


def read_event_values(
    spark: SparkSession,
    source: str,
    path: str | None = None,
    options: dict[str, str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Raw event texts as one STRING column ``value``.

    ``source='kafka'`` needs the Kafka connector on the classpath and the
    broker / topic / security settings in ``options``; it starts from the
    earliest offset like the reference.  ``source='json'`` reads new text files
    of a directory, one JSON event per line.
    """
    if source == "kafka":
        reader = spark.readStream.format("kafka").option("startingOffsets", "earliest")
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if source == "json":
        if path is None:
            raise ValueError("a json source needs a directory path")
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.text(path)
    raise ValueError(f"unknown stream source {source!r}")


def parse_events(values: DataFrame) -> DataFrame:
    """``value`` texts -> the six event fields + ``_corrupt_record`` (raw text of a bad
    record, ``null`` for a missing one)."""
    parsed = values.select("value", decode_json("value", POST_EVENT, corrupt_column=CORRUPT_COL).alias("e"))
    bad = F.when(F.col("value").isNull(), F.lit("null")).otherwise(F.col(f"e.{CORRUPT_COL}"))
    return parsed.select(*[F.col(f"e.{c}").alias(c) for c in POST_EVENT_FIELDS], bad.alias(CORRUPT_COL))


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)


def bad_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT_COL).isNotNull()).select(CORRUPT_COL)


# How far an event's own time may stand off its arrival before the arrival bounds it.
CLOCK_AHEAD = "5 minutes"
CLOCK_BEHIND = "30 minutes"


def event_clock(creation_date: str = "creation_date", ahead: str = CLOCK_AHEAD, behind: str = CLOCK_BEHIND) -> Column:
    """The time an event counts at: its own, held within [arrival - behind, arrival + ahead].

    ``creation_date`` arrives as epoch-seconds text.  The arrival is the micro-batch's
    time, which a replay of the batch takes from the checkpoint, so a retried task and a
    restarted query see the same clock.  An event without a readable time counts at its
    arrival.  Whatever a producer writes (a time in milliseconds, 1e300, 1970), it moves
    the watermark by ``ahead`` at most.
    """
    arrival = F.current_timestamp()
    seconds = F.col(creation_date).try_cast("double")
    # compared as numbers: a far time has no timestamp
    now, lo, hi = (x.cast("double") for x in (arrival, arrival - F.expr(f"INTERVAL {behind}"), arrival + F.expr(f"INTERVAL {ahead}")))
    usable = F.when(seconds.isNull() | F.isnan(seconds), now).otherwise(seconds)
    return F.timestamp_seconds(F.greatest(lo, F.least(hi, usable)))


def interval_seconds(spark: SparkSession, text: str) -> float:
    return float(spark.sql(f"SELECT CAST(timestamp_seconds(0) + INTERVAL {text} AS DOUBLE)").first()[0])


def dedupe_events(
    events: DataFrame, delay: str = "1 hour", ahead: str = CLOCK_AHEAD, behind: str = CLOCK_BEHIND
) -> DataFrame:
    """Drop repeated thread ids within ``delay``; every other event comes out.

    The watermark follows ``event_clock``: it lies ``delay`` behind the latest time seen,
    and no event counts more than ``behind`` before its arrival.  With ``ahead + behind``
    within ``delay`` no event is ever behind the watermark, so none is dropped as late:
    old, untimed and far-future events come out once, and cost no other event its place.
    The state holds the ids of the last ``delay + ahead + behind`` of arrivals, untimed
    ones included; a repeat that comes later than that is a new event.

    Events without a thread id are repeats only of events with the same content.
    """
    spark = events.sparkSession
    if interval_seconds(spark, ahead) + interval_seconds(spark, behind) > interval_seconds(spark, delay):
        raise ValueError(f"a delay of {delay} is shorter than {ahead} ahead and {behind} behind")
    content = F.when(F.col("thread_id").isNull(), F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}))
    keyed = events.withColumn("_clock", event_clock(ahead=ahead, behind=behind)).withColumn("_content", content)
    return keyed.withWatermark("_clock", delay).dropDuplicatesWithinWatermark(["thread_id", "_content"]).drop("_clock", "_content")


def flag_events(
    events: DataFrame,
    post_flags: DataFrame,
    community_flags: DataFrame,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
) -> DataFrame:
    """The batch rule applied to a stream (stream-static left joins)."""
    return apply_content_flag(events, post_flags, community_flags, salt_buckets)


def start_sink(
    flagged: DataFrame,
    sink: str,
    checkpoint: str,
    path: str | None = None,
    options: dict[str, str] | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the append-only sink.  ``sink`` is 'kafka', 'json' or 'parquet'."""
    if sink == "kafka":
        # Every field is written, missing ones as null (Spark would drop them).
        out = flagged.select(encode_json(flagged.columns).alias("value"))
        writer = out.writeStream.format("kafka")
        for k, v in (options or {}).items():
            writer = writer.option(k, v)
    elif sink in ("json", "parquet"):
        if path is None:
            raise ValueError("a file sink needs a path")
        writer = flagged.writeStream.format(sink).option("path", path)
    else:
        raise ValueError(f"unknown sink {sink!r}")
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


# Lookups of a micro-batch: (session, batch) -> (post flags, community flags).
Lookups = Callable[[SparkSession, DataFrame], tuple[DataFrame, DataFrame]]
# What a file that was replaced between its listing and its reading looks like (fixed names).
REPLACED = ("FILE_NOT_EXIST", "FAILED_READ_FILE", "PATH_NOT_FOUND", "FileNotFoundException", "UNABLE_TO_INFER_SCHEMA")
LOOKUP_ATTEMPTS = 5
LOOKUP_WAIT_S = 2.0


def stored_lookups(posts: str, community_flags: str) -> Lookups:
    """Flags of the batch's own threads and communities, from the files stored now.

    The stored posts are restricted to the batch's thread ids before they are grouped:
    the batch side is small and AQE broadcasts it by its measured size, so a micro-batch
    scans the id column of the store and shuffles only its own posts.
    """

    def read(spark: SparkSession, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        wanted = batch.select(F.col("thread_id").alias("post_id")).where("post_id IS NOT NULL").distinct()
        stored = spark.read.schema(LOOKUP_POSTS).parquet(posts).join(wanted, "post_id", "left_semi")
        communities = batch.select("subreddit").distinct()
        flags = spark.read.schema(LOOKUP_COMMUNITIES).parquet(community_flags).join(communities, "subreddit", "left_semi")
        # one row a community, whatever the folder holds
        flags = flags.groupBy("subreddit").agg(F.bool_or("community_adult").alias("community_adult"))
        return post_flags_from_posts(stored), flags

    return read


LOOKUP_POSTS = "post_id string, over_18 boolean"
LOOKUP_COMMUNITIES = "subreddit string, community_adult boolean"


def start_current_flags(
    events: DataFrame,
    lookups: Lookups,
    sink: str,
    checkpoint: str,
    path: str | None = None,
    options: dict[str, str] | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Flag a stream of events with the flags as they stand when each micro-batch runs.

    Every micro-batch is a batch job of its own: it reads the lookups afresh, so a flag
    that was stored after the stream began is seen from the next batch on, and AQE plans
    its joins by the measured sizes (no salt, skewed keys are split).  A lookup folder
    that is replaced while a batch reads it costs that batch another attempt.

    A file sink writes a batch into ``path/batch=<id>`` and replaces that folder when the
    batch is run again, after a lost driver for example: each batch is there once.  The
    Kafka sink is at-least-once.  ``events`` may come from ``dedupe_events``.
    """
    if sink not in ("kafka", "json", "parquet"):
        raise ValueError(f"unknown sink {sink!r}")
    if sink != "kafka" and path is None:
        raise ValueError("a file sink needs a path")

    def write(batch: DataFrame, batch_id: int) -> None:
        flagged = apply_content_flag(batch, *lookups(batch.sparkSession, batch))
        if sink == "kafka":
            out = flagged.select(encode_json(flagged.columns).alias("value")).write.format("kafka")
            for k, v in (options or {}).items():
                out = out.option(k, v)
            out.save()
        else:
            flagged.write.format(sink).mode("overwrite").save(f"{path}/batch={batch_id}")

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read for the lookup keys and for the join
        try:
            for left in range(LOOKUP_ATTEMPTS - 1, -1, -1):
                try:
                    return write(batch, batch_id)
                except Exception as e:
                    if not left or not any(x in str(e) for x in REPLACED):
                        raise
                    time.sleep(LOOKUP_WAIT_S)
        finally:
            batch.unpersist()

    writer = events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def await_all(queries: list[StreamingQuery], poll_s: float = 1.0) -> None:
    """Wait until all queries end; the first one's failure is raised at once."""
    while True:
        running = [q for q in queries if not q.awaitTermination(poll_s)]  # raises the query's error
        if not running:
            return


def read_flagged(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """The flagged events that ``start_current_flags`` wrote to files."""
    return spark.read.schema(POST_EVENT).format(fmt).load(path).select(*POST_EVENT_FIELDS)


# Columns of ``documents`` the stand-in event stream needs.
DOCUMENT_EVENT_SCHEMA = StructType(
    [StructField("doc_id", LongType(), True), StructField("source", StringType(), True)]
)


def document_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in event stream: the ``documents`` table read as a file stream."""
    docs = (
        spark.readStream.schema(DOCUMENT_EVENT_SCHEMA)
        .option("pathGlobFilter", "documents.parquet")
        .parquet(sf_dir)
    )
    return post_events_from_documents(docs)

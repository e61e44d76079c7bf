"""Stand-in datasets derived from the driver tables.

The jobs are written against the real datasets (listing snapshots, comment
snapshots, staging, post events); these functions derive each one from a
driver table with plain column expressions, so that every query reads the
given tables and its work grows with them.

| dataset            | derived from  | mapping                                               |
| ------------------ | ------------- | ----------------------------------------------------- |
| communities        | customer      | c_name -> subreddit_name, c_acctbal -> subscribers    |
| post snapshots     | orders        | o_orderkey -> post_id, o_custkey -> author_id, the    |
|                    |               | customer's name -> subreddit, o_orderdate -> created  |
|                    |               | and listing day, floor(o_totalprice) -> ups, status   |
|                    |               | 'F' -> over_18; hot order = ups desc, post_id         |
| comment snapshots  | events        | event_id -> comment_id, event_id DIV 10 -> post_id    |
|                    |               | (ten comments per post), user_id -> author_name,      |
|                    |               | floor(value) -> score, ts -> created_utc              |
| staging input      | events        | as comment snapshots; load time = creation time       |
| post events        | documents     | source -> subreddit, doc_id -> thread_id              |
| post flags         | labels        | toxic = 1 -> over_18 (no label = unknown)             |
| community flags    | documents +   | per source: (toxic + 1) / (labelled + 10) >= share    |
|                    | labels        |                                                       |
| reply tree         | conversations | turn n replies to turn n - 1 of the same conversation |
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.functions.dates import as_date, epoch_seconds
from agora.schemas import COMMENT_SNAPSHOT, POST_SNAPSHOT
from agora.sources.tables import read_table

# Community names are the customer names: 'Customer#' + key padded to 9 digits.
COMMUNITY_PREFIX = "Customer#"
COMMUNITY_KEY_WIDTH = 9
# Comments per stand-in post: comment i belongs to post i DIV this.
COMMENTS_PER_POST = 10
# A source counts as an adult community from this share of toxic documents among its
# labelled ones on; one toxic document in ten stands in for what is not labelled yet, so
# that a community with a few labels needs more than one.
COMMUNITY_ADULT_SHARE = 0.15
SHARE_PRIOR = (1, 10)


def _community_name_sql(key: str) -> str:
    return f"concat('{COMMUNITY_PREFIX}', lpad(CAST({key} AS STRING), {COMMUNITY_KEY_WIDTH}, '0'))"


def _epoch_seconds_sql(ts: str) -> str:
    # Same as ``functions.dates.epoch_seconds``: TIMESTAMP_NTZ read in the session zone (UTC).
    return f"CAST(unix_micros(CAST({ts} AS TIMESTAMP)) AS DOUBLE) / 1000000.0"


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def _conform(df: DataFrame, schema, values: dict[str, str]) -> DataFrame:
    """Project SQL ``values`` onto ``schema`` as one select list: missing fields NULL, types cast."""
    return df.selectExpr(
        *[f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields]
    )


def communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer", ["c_name", "c_acctbal"])
    return cust.select(
        F.col("c_name").alias("subreddit_name"),
        F.col("c_acctbal").cast("double").alias("subscribers_count"),
    )


def post_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(
        spark,
        sf_dir,
        "orders",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"],
    )
    return _conform(
        orders,
        POST_SNAPSHOT,
        {
            "snapshot_date": "CAST(o_orderdate AS DATE)",
            "subreddit": _community_name_sql("o_custkey"),
            "post_id": "CAST(o_orderkey AS STRING)",
            "created": _epoch_seconds_sql("o_orderdate"),
            "ups": "floor(o_totalprice)",
            "downs": "0",
            "over_18": "o_orderstatus = 'F'",
            "author_id": "CAST(o_custkey AS STRING)",
        },
    )


def broken_post_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing with bad records: posts of status 'P' have lost their author, urgent ones
    their creation time."""
    orders = read_table(
        spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    )
    return _conform(
        orders,
        POST_SNAPSHOT,
        {
            "snapshot_date": "CAST(o_orderdate AS DATE)",
            "subreddit": _community_name_sql("o_custkey"),
            "post_id": "CAST(o_orderkey AS STRING)",
            "created": f"IF(o_orderpriority = '1-URGENT', NULL, {_epoch_seconds_sql('o_orderdate')})",
            "ups": "floor(o_totalprice)",
            "author_id": "IF(o_orderstatus = 'P', NULL, CAST(o_custkey AS STRING))",
        },
    )


def standin_hot_order() -> list[Column]:
    """Hot order of the stand-in listing (a real snapshot carries ``hot_rank``)."""
    return [F.col("ups").desc_nulls_last(), F.col("post_id").asc()]


def comment_snapshots(spark: SparkSession, sf_dir: str, run_date: dt.date | str | None = None) -> DataFrame:
    """Comment snapshots; with ``run_date`` only that UTC day is read (pushed to Parquet)."""
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    window = ts_window(run_date)
    if window is not None:
        events = events.where(window)
    return _conform(
        events,
        COMMENT_SNAPSHOT,
        {
            "post_id": f"CAST(event_id DIV {COMMENTS_PER_POST} AS STRING)",
            "comment_id": "CAST(event_id AS STRING)",
            "author_name": "CAST(user_id AS STRING)",
            "score": "floor(value)",
            "created_utc": _epoch_seconds_sql("ts"),
        },
    )


def ts_window(start: dt.date | str | None, end: dt.date | str | None = None, col: str = "ts") -> Column | None:
    """``start <= ts < end`` on a raw TIMESTAMP_NTZ column, as literals Parquet can push down.

    The jobs filter on derived epoch seconds, which a scan cannot use; the
    stand-in readers add this equivalent range on the stored column.
    """
    if start is None:
        return None
    lo = as_date(start)
    hi = as_date(end) if end is not None else lo + dt.timedelta(days=1)
    # A text literal: parsing it as TIMESTAMP_NTZ does not depend on any time
    # zone (a Python datetime literal would pass through the driver's zone).
    as_ntz = lambda d: F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")
    return (F.col(col) >= as_ntz(lo)) & (F.col(col) < as_ntz(hi))


def stored_comments(
    spark: SparkSession, sf_dir: str, start: dt.date | str | None = None, end: dt.date | str | None = None
) -> DataFrame:
    """The comment collection as the staging job reads it.

    Only the two fields staging needs plus the filter field; the load time of a
    stand-in comment is its creation time.  With ``start`` the scan keeps only
    ``[start, end)`` (pushed to Parquet).
    """
    events = read_table(spark, sf_dir, "events", ["ts", "user_id"])
    window = ts_window(start, end)
    if window is not None:
        events = events.where(window)
    created = epoch_seconds("ts")
    return events.select(
        F.col("user_id").cast("string").alias("author_name"),
        created.alias("created_utc"),
        created.alias("etl_ts"),
    )


def post_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "source"])
    return post_events_from_documents(docs)


def post_events_from_documents(docs: DataFrame, creation_date: str | None = None) -> DataFrame:
    """Post events; ``creation_date`` names a column with their times as text, if any."""
    return docs.select(
        F.col("source").alias("subreddit"),
        F.col("doc_id").cast("string").alias("thread_id"),
        _null("string").alias("author_id"),
        (F.col(creation_date) if creation_date else _null("string")).alias("creation_date"),
        _null("string").alias("url"),
        _null("boolean").alias("is_violation"),
    )


def post_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per labelled post: ``thread_id, post_adult``."""
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    return labels.groupBy("doc_id").agg(F.bool_or(F.col("toxic") == 1).alias("post_adult")).select(
        F.col("doc_id").cast("string").alias("thread_id"), "post_adult"
    )


def community_flags(
    spark: SparkSession, sf_dir: str, share: float = COMMUNITY_ADULT_SHARE
) -> DataFrame:
    """One row per community with a label: ``subreddit, community_adult``.

    A share does not grow with the data, so the flags mean the same at any size.
    Communities without any labelled document get no row; the flag rule reads
    a missing community as not adult.  Partial aggregation runs before the shuffle on ``source``, so
    a community holding a third of all documents sends one row per task.
    """
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "source"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    toxic, labelled = SHARE_PRIOR
    smoothed = (F.coalesce(F.sum("toxic"), F.lit(0)) + toxic) / (F.count("toxic") + labelled)
    return (
        docs.join(labels, "doc_id")
        .groupBy("source")
        .agg((smoothed >= F.lit(share)).alias("community_adult"))
        .select(F.col("source").alias("subreddit"), "community_adult")
    )


def reply_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat comment tree: ``post_id, comment_id, parent_id, author_name``."""
    conv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role"])
    key = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    return conv.select(
        F.col("conv_id").cast("string").alias("post_id"),
        key(F.col("turn")).alias("comment_id"),
        F.when(F.col("turn") > 0, key(F.col("turn") - 1)).alias("parent_id"),
        F.col("role").alias("author_name"),
    )


def comment_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed posts with their comments as nested JSON: ``post_id, comments``.

    Turn n of a conversation answers turn (n - 1) // 2, so comments have up to two
    replies.  The JSON is folded from the last turn to the first: a turn takes what the
    turns after it hung below it.  A conversation is small (a few turns).
    """
    conv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role"])
    turns = conv.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role")), asc=False).alias("turns"))
    # acc: by turn, the JSON of the turns that hang below it; -1 holds the top level
    up = "IF(x.turn > 0, (x.turn - 1) DIV 2, -1L)"
    own = """concat(
        '{"comment_id":"', conv_id, ':', x.turn, '","author_name":', IF(x.role IS NULL, 'null', concat('"', x.role, '"')),
        ',"score":', x.turn % 3, ',"created_utc":', 1704672000 + x.turn,
        ',"replies":[', coalesce(try_element_at(acc, x.turn), ''), ']}')"""
    folded = f"""aggregate(turns, CAST(map() AS MAP<BIGINT, STRING>), (acc, x) -> map_concat(
        map_filter(acc, (k, v) -> k <> {up}), map({up}, concat_ws(',', {own}, try_element_at(acc, {up})))))"""
    return turns.select(
        F.col("conv_id").cast("string").alias("post_id"),
        F.expr(f"concat('[', coalesce(try_element_at({folded}, -1L), ''), ']')").alias("comments"),
    )


def tree_posts(trees: DataFrame) -> DataFrame:
    """The stored posts that the trees belong to, in seven communities."""
    return trees.select("post_id", F.concat(F.lit("c"), (F.col("post_id").cast("long") % 7).cast("string")).alias("subreddit"))

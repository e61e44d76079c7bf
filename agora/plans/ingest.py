"""Daily ingest of posts (Q5) and comments (Q6) from landed snapshots.

The reference loops over communities and posts, calling a remote client per
item.  Here the listing and comment snapshots are landed datasets and each
ingest is one plan over all communities:

posts:    top-N communities (TakeOrderedAndProject - N rows)
          -> IN filter on the listing snapshots (partition pruning)
          -> first ``per_community`` per (listing day, community) in hot order
          -> keep posts created on the listing day (UTC)
          -> falsy -> missing, comment count -> 0, drop empty records
          -> add load time, community and the ``etl_date`` partition column
comments: post ids of the stored posts of the top-N communities
          -> join the comment snapshots on post id (AQE broadcasts a small side
             and splits a hot post)
          -> keep comments created on the run day -> clean -> add columns

``run_date=None`` processes every landed day in one job (a backfill); with a
date, the snapshot filter prunes partitions / pushes the time range down.
Rejected records (deleted author, no creation time) come out of
``split_rejected`` for a quarantine output instead of being lost silently.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.functions.cleaning import (
    drop_empty_records,
    falsy_bool_sql,
    falsy_number_sql,
    falsy_text_sql,
    zero_if_missing_sql,
)
from agora.functions.dates import as_date, day_window, epoch_seconds, epoch_to_date
from agora.operators.joins import lookup_join
from agora.operators.topn import first_n_per_group, top_communities
from agora.schemas import COMMENT_FIELDS, POST_FIELDS, POSTS

# Workload constants of the jobs (fixed values).
TOP_COMMUNITIES = 25
HOT_POSTS_PER_COMMUNITY = 100


_RULE_SQL = {
    "text": falsy_text_sql,
    "number": falsy_number_sql,
    "bool": falsy_bool_sql,
    "zero": zero_if_missing_sql,
}


def _rules(df: DataFrame, fields: Sequence[str], zero_fields: Sequence[str] = ()) -> dict[str, str]:
    rules = {}
    types = dict(df.dtypes)
    for f in fields:
        t = types[f]
        if f in zero_fields:
            rules[f] = "zero"
        elif t == "string":
            rules[f] = "text"
        elif t == "boolean":
            rules[f] = "bool"
        else:
            rules[f] = "number"
    return rules


def _clean(df: DataFrame, fields: Sequence[str], rules: dict[str, str], overrides: dict[str, str]) -> DataFrame:
    """One select list: each field through its rule, other columns unchanged."""
    keep = [f"`{c}`" for c in df.columns if c not in fields]
    exprs = [f"{overrides.get(f) or _RULE_SQL[rules[f]](f)} AS `{f}`" for f in fields]
    return df.selectExpr(*exprs, *keep)


def clean_posts(df: DataFrame) -> DataFrame:
    """Falsy -> missing for every post field; missing comment count -> 0."""
    return _clean(df, POST_FIELDS, _rules(df, POST_FIELDS, zero_fields=("num_comments",)), {})


def clean_comments(df: DataFrame) -> DataFrame:
    """Falsy -> missing for every comment field ('false' counts as falsy for ``edited``)."""
    edited = "CASE WHEN lower(`edited`) IN ('false', '0', '0.0', '') THEN NULL ELSE `edited` END"
    return _clean(df, COMMENT_FIELDS, _rules(df, COMMENT_FIELDS), {"edited": edited})


def split_rejected(df: DataFrame, rejected: Column) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``: the reference logs and skips such records."""
    flag = F.coalesce(rejected, F.lit(False))
    return df.where(~flag), df.where(flag)


def top_names(communities: DataFrame, top_n: int) -> list[str]:
    """Names of the top-N communities (at most N rows reach the driver)."""
    return [r[0] for r in top_communities(communities, top_n).select("subreddit_name").collect()]


def restrict_to_top(
    df: DataFrame, communities: DataFrame, top_n: int, col: str = "subreddit", names: list[str] | None = None
) -> DataFrame:
    """Keep rows of the top-N communities.

    The list (N names, a parameter of the job) is applied as ``col IN (...)``: on a
    landing zone partitioned by community that is a partition filter (only N folders
    are listed and read), on other Parquet data a pushed filter.  A semi join would do
    neither.  ``names`` (from ``top_names``) lets several steps of one job share a pick.
    """
    if names is None:
        names = top_names(communities, top_n)
    return df.where(F.col(col).isin(names))


def ingest_posts(
    snapshots: DataFrame,
    communities: DataFrame,
    run_date: dt.date | str | None = None,
    top_n: int = TOP_COMMUNITIES,
    per_community: int = HOT_POSTS_PER_COMMUNITY,
    hot_order: Sequence[Column] | None = None,
    with_rejected: bool = False,
    names: list[str] | None = None,
):
    """Posts of the day(s) for the top-N communities, cleaned, in the POSTS layout.

    Output: POSTS columns + ``etl_date`` (listing day, the partition column).
    ``etl_ts`` is the listing day's midnight in epoch seconds, so re-runs give
    identical rows.  With ``with_rejected`` returns ``(accepted, rejected)``.
    """
    order = list(hot_order) if hot_order else [F.col("hot_rank").asc_nulls_last(), F.col("post_id").asc()]
    snaps = snapshots
    if run_date is not None:
        snaps = snaps.where(F.col("snapshot_date") == F.lit(as_date(run_date)))
    snaps = restrict_to_top(snaps, communities, top_n, names=names)
    listed = first_n_per_group(snaps, ["snapshot_date", "subreddit"], order, per_community)
    same_day = listed.where(F.col("created").isNull() | (epoch_to_date("created") == F.col("snapshot_date")))
    deleted_author = F.col("author_name").isNull() & F.col("author_id").isNull()
    accepted, rejected = split_rejected(same_day, deleted_author | F.col("created").isNull())
    cleaned = drop_empty_records(clean_posts(accepted), POST_FIELDS)
    out = cleaned.select(
        *[F.col(f.name) for f in POSTS.fields if f.name in POST_FIELDS],
        epoch_seconds(F.col("snapshot_date").cast("timestamp")).alias("etl_ts"),
        F.col("subreddit"),
        F.col("snapshot_date").alias("etl_date"),
    )
    return (out, rejected) if with_rejected else out


def post_keys(
    stored_posts: DataFrame, communities: DataFrame, top_n: int = TOP_COMMUNITIES, names: list[str] | None = None
) -> DataFrame:
    """Distinct ``(post_id, subreddit)`` of the stored posts of the top-N communities.

    The de-duplication absorbs re-runs that appended the same post twice.
    """
    keys = stored_posts.select("post_id", "subreddit").where(F.col("post_id").isNotNull())
    return restrict_to_top(keys, communities, top_n, names=names).dropDuplicates(["post_id", "subreddit"])


def ingest_comments(
    comment_snapshots: DataFrame,
    stored_posts: DataFrame,
    communities: DataFrame,
    run_date: dt.date | str | None = None,
    top_n: int = TOP_COMMUNITIES,
    with_rejected: bool = False,
    names: list[str] | None = None,
):
    """Comments of the day(s) under the stored posts of the top-N communities.

    Output: COMMENTS columns + ``etl_date`` (the comment's UTC day).
    """
    comments = comment_snapshots
    if run_date is not None:
        # a record without a creation time belongs to no day: it goes on, to the rejects
        comments = comments.where(day_window("created_utc", as_date(run_date)) | F.col("created_utc").isNull())
    keys = post_keys(stored_posts, communities, top_n, names=names)
    joined = lookup_join(comments, keys, "post_id", "inner")
    day = epoch_to_date("created_utc")
    accepted, rejected = split_rejected(joined, F.col("created_utc").isNull())
    cleaned = drop_empty_records(clean_comments(accepted), COMMENT_FIELDS)
    out = cleaned.select(
        "post_id",
        "parent_id",
        *COMMENT_FIELDS,
        epoch_seconds(day.cast("timestamp")).alias("etl_ts"),
        "subreddit",
        day.alias("etl_date"),
    )
    return (out, rejected) if with_rejected else out


def bucket_by_post(df: DataFrame, table: str, buckets: int, path: str) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``post_id`` and return the table.

    Two such tables with the same number of buckets join on ``post_id`` bucket by bucket:
    neither side is shuffled.  Rows are dealt by the bucket's own hash first, so a bucket
    is one file.  A post's comments share a bucket; for a post that holds a large share of
    all comments the plain join, which AQE splits, is the better plan.
    """
    rows = df.repartition(buckets, "post_id")
    rows.write.mode("overwrite").bucketBy(buckets, "post_id").sortBy("post_id").option("path", path).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def flatten_comment_tree(posts_with_tree: DataFrame, replies_field: str = "replies") -> DataFrame:
    """Nested comments (``comments: array<struct<..., replies: array<struct>>>``) -> flat rows.

    Spark has no recursive type, so the schema says how deep a snapshot is; every
    level of it is walked.  All levels come out of one scan: each top-level comment
    becomes the array of its whole subtree, which is exploded.  Every row keeps its
    ``post_id`` and gets ``parent_id`` (NULL at the top level), ``depth`` and
    ``reply_count`` (size of its direct replies; NULL where the schema has none).
    Collapsed placeholders (records without ``comment_id``) are skipped, not what
    hangs below them.
    """
    top = posts_with_tree.schema["comments"].dataType.elementType
    plain: dict[str, str] = {}
    kind = top
    while kind is not None:
        below = None
        for f in kind.fields:
            if f.name == replies_field:
                below = f.dataType.elementType
            else:
                plain.setdefault(f.name, f.dataType.simpleString())
        kind = below

    def row(c: Column, kind, parent: Column, depth: int) -> Column:
        has = set(kind.names)
        size = F.size(c[replies_field]) if replies_field in has else F.lit(None)
        return F.struct(
            parent.cast("string").alias("parent_id"),
            *[(c[n] if n in has else F.lit(None)).cast(t).alias(n) for n, t in plain.items()],
            F.lit(depth).alias("depth"),
            F.when(size >= 0, size).cast("int").alias("reply_count"),
        )

    def subtree(c: Column, kind, parent: Column, depth: int) -> Column:
        own = F.array(row(c, kind, parent, depth))
        if replies_field not in kind.names:
            return own
        inner = kind[replies_field].dataType.elementType
        below = F.flatten(F.transform(c[replies_field], lambda r: subtree(r, inner, c["comment_id"], depth + 1)))
        return F.when(F.coalesce(F.size(c[replies_field]), F.lit(0)) > 0, F.concat(own, below)).otherwise(own)

    trees = F.transform(
        F.filter("comments", lambda c: c.isNotNull()), lambda c: subtree(c, top, F.lit(None).cast("string"), 0)
    )
    flat = posts_with_tree.select("post_id", F.explode(F.flatten(trees)).alias("c"))
    return flat.select("post_id", "c.*").where(F.col("comment_id").isNotNull())

"""Registered queries: each a ``(spark, sf_dir) -> DataFrame`` over the driver
tables, paired with an equivalent DuckDB SQL text (the correctness oracle).

Every query reads whole tables; parameters such as the report week or the
staging day are the features of the query, not sampling.  The oracle texts
are written independently of the Spark plans where the semantics allow (for
example the week masks are checked against per-day conditions, not against
the same bit arithmetic).
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.operators import counts, topn
from agora.operators.calendar import week_masks_of_days
from agora.operators.distinct import distinct_rows
from agora.plans import comment_trees, ingest, moderation, reports_sql, user_days
from agora.plans import staging as staging_plan
from agora.plans import weekly
from agora.functions.json import encode_json
from agora.schemas import POST_EVENT
from agora.session import configure, scratch_dir
from agora.sinks.batch import write_partitioned
from agora.sources import files, standins
from agora.sources.tables import read_table
from agora.streaming import content_flag

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
# Queries with no SQL oracle, and why (checked rows-only by the driver).
NO_ORACLE: set[str] = set()


# Queries that run several loads or stream batches while they build their result; the
# bench times the others.
SCENARIOS: set[str] = set()


def register(name: str, oracle: str | None = None, scenario: bool = False):
    """Register a query; it runs with the jobs' session settings (UTC, AQE, broadcast policy)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if scenario:
            SCENARIOS.add(name)
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return run

    return deco


# --------------------------------------------------------------------------
# Shared SQL fragments of the oracle (DuckDB dialect).

# Staging as the stand-in defines it: every stored comment, author as text.
SQL_STAGING = """
stg AS (
    SELECT coalesce(CAST(user_id AS VARCHAR), 'None') AS author_id,
           CAST(ts AS DATE) AS etl_ts
    FROM events
)"""

# Report week rows (ISO week 2, no year test) and per-day activity, Sunday first.
SQL_WEEK = (
    SQL_STAGING
    + """,
wk AS (
    SELECT author_id, etl_ts FROM stg
    WHERE weekofyear(etl_ts) = 2 AND author_id <> 'None'
),
per_user AS (
    SELECT author_id,
           count(DISTINCT CASE WHEN etl_ts BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
                               THEN etl_ts END) AS n_days,
           (CASE WHEN bool_or(etl_ts = DATE '2024-01-14') THEN '1' ELSE '0' END) ||
           (CASE WHEN bool_or(etl_ts = DATE '2024-01-13') THEN '1' ELSE '0' END) ||
           (CASE WHEN bool_or(etl_ts = DATE '2024-01-12') THEN '1' ELSE '0' END) ||
           (CASE WHEN bool_or(etl_ts = DATE '2024-01-11') THEN '1' ELSE '0' END) ||
           (CASE WHEN bool_or(etl_ts = DATE '2024-01-10') THEN '1' ELSE '0' END) ||
           (CASE WHEN bool_or(etl_ts = DATE '2024-01-09') THEN '1' ELSE '0' END) ||
           (CASE WHEN bool_or(etl_ts = DATE '2024-01-08') THEN '1' ELSE '0' END) AS weekly_activity
    FROM wk GROUP BY author_id
)"""
)


def _view(kind: str) -> str:
    """A temp-view name of its own for one query call (no clash between calls)."""
    return f"agora_{kind}_{uuid.uuid4().hex[:12]}"


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_plan.stage_users(standins.stored_comments(spark, sf_dir))


# --------------------------------------------------------------------------
# Weekly reports (Q1-Q3) and their generalisations.


SQL_ACTIVE_DAYS = (
    "WITH"
    + SQL_WEEK
    + """
SELECT author_id, CAST(n_days AS INTEGER) AS user_num_active_in_week FROM per_user"""
)


@register("weekly_active_days", SQL_ACTIVE_DAYS)
def q_weekly_active_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly.weekly_active_days(_staging(spark, sf_dir))


@register("weekly_active_days_literal", SQL_ACTIVE_DAYS)
def q_weekly_active_days_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 through the reports' own plan shape (day set, calendar, sum of powers)."""
    return weekly.weekly_active_days(_staging(spark, sf_dir), literal=True)


ORACLE_RATE = (
    "WITH"
    + SQL_WEEK
    + """
SELECT author_id, weekly_activity,
       round(CAST(n_days AS DOUBLE) / 7.0, 2) AS avg_activity_rate_per_week
FROM per_user"""
)


@register("weekly_activity_rate", ORACLE_RATE)
def q_weekly_activity_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly.weekly_activity_rate(_staging(spark, sf_dir))


ORACLE_FLAGS = (
    "WITH"
    + SQL_WEEK
    + """
SELECT author_id, weekly_activity,
       CASE WHEN weekly_activity = '1111111' THEN 1 ELSE 0 END AS is_active_7_consecutive_days,
       CASE WHEN weekly_activity LIKE '111111_' OR weekly_activity LIKE '_111111'
            THEN 1 ELSE 0 END AS is_active_6_consecutive_days,
       CASE WHEN weekly_activity LIKE '11111_1' OR weekly_activity LIKE '1_11111'
            THEN 1 ELSE 0 END AS is_active_5_consecutive_days
FROM per_user"""
)


@register("consecutive_day_flags", ORACLE_FLAGS)
def q_consecutive_day_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly.consecutive_day_flags(_staging(spark, sf_dir))


@register(
    "longest_streak",
    "WITH" + SQL_STAGING + """,
days AS (SELECT DISTINCT author_id, etl_ts FROM stg WHERE author_id <> 'None' AND etl_ts IS NOT NULL),
isl AS (
    SELECT author_id,
           etl_ts - CAST(row_number() OVER (PARTITION BY author_id ORDER BY etl_ts) AS INTEGER) AS island
    FROM days
),
runs AS (SELECT author_id, island, count(*) AS n FROM isl GROUP BY author_id, island)
SELECT author_id, max(n) AS longest_streak FROM runs GROUP BY author_id""",
)
def q_longest_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly.longest_streak(_staging(spark, sf_dir))


@register(
    "weekly_active_users_total",
    "WITH" + SQL_STAGING + """
SELECT CAST(date_trunc('week', etl_ts) AS DATE) AS week_start,
       CAST(weekofyear(etl_ts) AS INTEGER) AS iso_week,
       count(DISTINCT author_id) AS active_users
FROM stg WHERE author_id <> 'None' AND etl_ts IS NOT NULL
GROUP BY 1, 2""",
)
def q_weekly_active_users_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly.weekly_active_users(_staging(spark, sf_dir))


@register("weekly_active_days_sql", SQL_ACTIVE_DAYS)
def q_weekly_active_days_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 as Spark SQL text over a ``dim_all_users_stg`` view."""
    return reports_sql.run_report(spark, "active_days", _staging(spark, sf_dir), view=_view("stg"))


@register("weekly_activity_rate_sql", ORACLE_RATE)
def q_weekly_activity_rate_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 as Spark SQL text."""
    return reports_sql.run_report(spark, "activity_rate", _staging(spark, sf_dir), view=_view("stg"))


@register("consecutive_day_flags_sql", ORACLE_FLAGS)
def q_consecutive_day_flags_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 as Spark SQL text."""
    return reports_sql.run_report(spark, "consecutive_days", _staging(spark, sf_dir), view=_view("stg"))


# --------------------------------------------------------------------------
# Staging load (Q4).

STAGE_DAY = "2024-01-08"


@register(
    "dim_all_users_stage",
    """
SELECT coalesce(CAST(user_id AS VARCHAR), 'None') AS author_id, CAST(ts AS DATE) AS etl_ts
FROM events
WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-09 00:00:00'""",
)
def q_dim_all_users_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily load of one run day (the staging job's unit of work)."""
    return staging_plan.stage_users(standins.stored_comments(spark, sf_dir, STAGE_DAY), STAGE_DAY)


@register(
    "dim_all_users_backfill",
    """
SELECT coalesce(CAST(user_id AS VARCHAR), 'None') AS author_id, CAST(ts AS DATE) AS etl_ts
FROM events""",
)
def q_dim_all_users_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the comment collection staged in one job."""
    return _staging(spark, sf_dir)


# --------------------------------------------------------------------------
# Loads kept across runs.

BACKFILL = ("2024-01-01", "2024-03-01")


class _Refused(Exception):
    """An audit that keeps a run unpublished."""


def _load_staging(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Two daily loads, one that its audit refuses, then a backfill that covers them."""
    for day, end in (("2024-01-08", "2024-01-09"), ("2024-01-09", "2024-01-10")):
        staged = staging_plan.stage_users(standins.stored_comments(spark, sf_dir, day, end), day, end)
        staging_plan.publish_staging(staged, path, day, end)

    def refuse(rows: dict[str, int]) -> None:
        raise _Refused(rows)

    try:
        staging_plan.publish_staging(_staging(spark, sf_dir), path, "2024-01-10", "2024-01-11", audit=refuse)
    except _Refused:
        pass
    staging_plan.publish_staging(_staging(spark, sf_dir), path, *BACKFILL)


@register(
    "staging_published",
    """
SELECT coalesce(CAST(user_id AS VARCHAR), 'None') AS author_id, CAST(ts AS DATE) AS etl_ts
FROM events WHERE ts IS NOT NULL""",
    scenario=True,
)
def q_staging_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table after daily loads, a refused load and the backfill over them (K3)."""
    path = scratch_dir(spark, "staging_published")
    _load_staging(spark, sf_dir, path)
    return staging_plan.read_staging(spark, path)


@register("weekly_active_days_stored", SQL_ACTIVE_DAYS, scenario=True)
def q_weekly_active_days_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 from the stored staging table; the calendar join prunes its day folders."""
    path = scratch_dir(spark, "weekly_active_days_stored")
    staging_plan.publish_staging(_staging(spark, sf_dir), path, *BACKFILL)
    return weekly.weekly_active_days(masks=week_masks_of_days(staging_plan.read_staging(spark, path)))


def _flags_of_week(monday: str) -> str:
    """Q3's oracle for the week from ``monday`` on, of that year only."""
    days = [f"bool_or(etl_ts = DATE '{monday}' + {k})" for k in range(6, -1, -1)]
    text = " || ".join(f"(CASE WHEN {d} THEN '1' ELSE '0' END)" for d in days)
    return (
        "WITH" + SQL_STAGING + f""",
per_user AS (
    SELECT author_id, {text} AS weekly_activity FROM stg
    WHERE etl_ts BETWEEN DATE '{monday}' AND DATE '{monday}' + 6 AND author_id <> 'None'
    GROUP BY author_id
)""" + ORACLE_FLAGS[ORACLE_FLAGS.index("\nSELECT author_id, weekly_activity,"):]
    )


@register("consecutive_day_flags_week4", _flags_of_week("2024-01-22"), scenario=True)
def q_consecutive_day_flags_week4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 for another week of that year only, pruned to its seven folders (G1)."""
    path = scratch_dir(spark, "consecutive_day_flags_week4")
    staging_plan.publish_staging(_staging(spark, sf_dir), path, *BACKFILL)
    masks = week_masks_of_days(staging_plan.read_staging(spark, path), 2024, 4, every_year=False)
    return weekly.consecutive_day_flags(masks=masks)


@register("weekly_flags_incremental", _flags_of_week("2024-01-08"), scenario=True)
def q_weekly_flags_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 from masks that each day's load was ORed into, one day twice (A2)."""
    path = scratch_dir(spark, "weekly_flags_incremental")
    for day in (8, 9, 10, 11, 12, 13, 14, 10):
        date = f"2024-01-{day:02d}"
        user_days.add_to_week_masks(staging_plan.stage_users(standins.stored_comments(spark, sf_dir, date), date), path)
    return weekly.consecutive_day_flags(masks=user_days.week_masks(spark, path, dt.date(2024, 1, 8)))


@register(
    "active_users_spans",
    "WITH" + SQL_STAGING + """,
act AS (SELECT DISTINCT author_id, etl_ts AS day FROM stg WHERE author_id <> 'None' AND etl_ts IS NOT NULL),
days AS (SELECT DISTINCT day FROM act)
SELECT days.day,
       count(DISTINCT CASE WHEN act.day = days.day THEN author_id END) AS active_1,
       count(DISTINCT CASE WHEN act.day > days.day - 7 THEN author_id END) AS active_7,
       count(DISTINCT author_id) AS active_28
FROM days JOIN act ON act.day <= days.day AND act.day > days.day - 28
GROUP BY days.day""",
    scenario=True,
)
def q_active_users_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active users of 1, 7 and 28 days from one table of day bitmaps."""
    path = scratch_dir(spark, "active_users_spans")
    staged = _staging(spark, sf_dir)
    users = user_days.number_new_users(staged, f"{path}/users", "backfill")
    user_days.add_bitmaps(staged, users, f"{path}/days", *BACKFILL)
    return user_days.active_users(user_days.day_bitmaps(spark, f"{path}/days"))


@register("longest_streak_periods", ORACLE["longest_streak"])
def q_longest_streak_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest streaks from run summaries: weeks merged into months, months into all time.

    A week belongs to the month of its Monday, so that no period overlaps another.
    """
    weeks = user_days.period_runs(_staging(spark, sf_dir), F.date_trunc("week", "day").cast("date"))
    months = user_days.combined_runs(weeks, F.date_trunc("month", "period").cast("date"))
    return user_days.longest_streaks(user_days.combined_runs(months))


# --------------------------------------------------------------------------
# Communities, listings and ingest.

SQL_TOP = """
top AS (
    SELECT c_name AS subreddit_name,
           CASE WHEN isnan(c_acctbal) THEN NULL ELSE c_acctbal END AS subscribers_count
    FROM customer
    ORDER BY subscribers_count DESC NULLS LAST, subreddit_name ASC
    LIMIT 25
)"""

SQL_SNAP = """
snap AS (
    SELECT CAST(o_orderdate AS DATE) AS snapshot_date,
           'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS subreddit,
           CAST(o_orderkey AS VARCHAR) AS post_id,
           CAST(epoch_us(o_orderdate) AS DOUBLE) / 1000000.0 AS created,
           CAST(floor(o_totalprice) AS BIGINT) AS ups,
           CAST(0 AS BIGINT) AS downs,
           o_orderstatus = 'F' AS over_18,
           CAST(o_custkey AS VARCHAR) AS author_id
    FROM orders
)"""

# Posts of the top communities, first 100 per (day, community), cleaned.
SQL_POSTS = (
    SQL_TOP
    + ","
    + SQL_SNAP
    + """,
listed AS (
    SELECT *, row_number() OVER (PARTITION BY snapshot_date, subreddit
                                 ORDER BY ups DESC NULLS LAST, post_id) AS rn
    FROM snap WHERE subreddit IN (SELECT subreddit_name FROM top)
),
posts AS (
    SELECT CAST(NULL AS VARCHAR) AS title,
           nullif(post_id, '') AS post_id,
           CAST(NULL AS VARCHAR) AS subreddit_id,
           nullif(created, 0) AS created,
           CAST(NULL AS DOUBLE) AS banned_at_utc,
           CAST(NULL AS VARCHAR) AS distinguished,
           CAST(NULL AS VARCHAR) AS url,
           CAST(0 AS BIGINT) AS num_comments,
           nullif(ups, 0) AS ups,
           nullif(downs, 0) AS downs,
           CASE WHEN over_18 THEN true END AS over_18,
           CAST(NULL AS VARCHAR) AS removal_reason,
           CAST(NULL AS BIGINT) AS num_reports,
           CAST(NULL AS VARCHAR) AS subreddit_type,
           CAST(NULL AS VARCHAR) AS author_name,
           nullif(author_id, '') AS author_id,
           CAST(NULL AS BIGINT) AS author_link_karma,
           CAST(NULL AS VARCHAR) AS flair,
           CAST(epoch_us(CAST(snapshot_date AS TIMESTAMP)) AS DOUBLE) / 1000000.0 AS etl_ts,
           subreddit,
           snapshot_date AS etl_date
    FROM listed
    WHERE rn <= 100 AND CAST(to_timestamp(created) AT TIME ZONE 'UTC' AS DATE) = snapshot_date
)"""
)


def _posts(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> DataFrame:
    return ingest.ingest_posts(
        standins.post_snapshots(spark, sf_dir),
        standins.communities(spark, sf_dir),
        hot_order=standins.standin_hot_order(),
        names=names,
    )


def _comments(spark: SparkSession, sf_dir: str, run_date: str | None = None) -> DataFrame:
    """Comment ingest over the stored posts; the top-N pick is made once for both steps."""
    communities = standins.communities(spark, sf_dir)
    names = ingest.top_names(communities, ingest.TOP_COMMUNITIES)
    return ingest.ingest_comments(
        standins.comment_snapshots(spark, sf_dir, run_date),
        _posts(spark, sf_dir, names),
        communities,
        run_date=run_date,
        names=names,
    )


@register("top_n_communities", "WITH" + SQL_TOP + "\nSELECT * FROM top")
def q_top_n_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_communities(standins.communities(spark, sf_dir), ingest.TOP_COMMUNITIES)


@register(
    "distinct_post_ids",
    "WITH" + SQL_SNAP + "\nSELECT DISTINCT subreddit, post_id FROM snap",
)
def q_distinct_post_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct post ids per community (all communities in one job)."""
    snaps = standins.post_snapshots(spark, sf_dir)
    return distinct_rows(snaps.select("subreddit", "post_id"))


@register(
    "top_posts_per_community",
    "WITH"
    + SQL_SNAP
    + """,
ranked AS (
    SELECT subreddit, post_id, ups,
           row_number() OVER (PARTITION BY subreddit ORDER BY ups DESC NULLS LAST, post_id) AS hot_rank
    FROM snap
)
SELECT subreddit, post_id, ups, CAST(hot_rank AS INTEGER) AS hot_rank FROM ranked WHERE hot_rank <= 100""",
)
def q_top_posts_per_community(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot listing: the first 100 posts of every community."""
    snaps = standins.post_snapshots(spark, sf_dir).select("subreddit", "post_id", "ups")
    return topn.first_n_per_group(
        snaps, ["subreddit"], standins.standin_hot_order(), ingest.HOT_POSTS_PER_COMMUNITY, rank_col="hot_rank"
    )


LONG_LISTING = 1001


@register(
    "long_listing",
    f"""
WITH ranked AS (
    SELECT o_orderstatus = 'F' AS over_18, CAST(o_orderkey AS VARCHAR) AS post_id, CAST(floor(o_totalprice) AS BIGINT) AS ups,
           row_number() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY floor(o_totalprice) DESC NULLS LAST,
                              CAST(o_orderkey AS VARCHAR)) AS hot_rank
    FROM orders
)
SELECT over_18, post_id, ups, CAST(hot_rank AS INTEGER) AS hot_rank FROM ranked WHERE hot_rank <= {LONG_LISTING}""",
)
def q_long_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 1001 posts of the adult and of the other half: groups beyond any task, ranked by ranges."""
    snaps = standins.post_snapshots(spark, sf_dir).select("over_18", "post_id", "ups")
    return topn.first_n_per_group(snaps, ["over_18"], standins.standin_hot_order(), LONG_LISTING, rank_col="hot_rank")


@register(
    "communities_csv",
    """
SELECT c_name AS subreddit_name,
       CASE WHEN isnan(c_acctbal) OR c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal END AS subscribers_count
FROM customer""",
    scenario=True,
)
def q_communities_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The community list through its CSV reader: other columns beside, missing words as NULL."""
    path = scratch_dir(spark, "communities_csv")
    cust = read_table(spark, sf_dir, "customer", ["c_name", "c_acctbal", "c_mktsegment"])
    count = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    cust.select("c_mktsegment", count.alias("subscribers_count"), F.col("c_name").alias("subreddit_name")).write.option(
        "header", "true"
    ).csv(f"{path}/list")
    return files.read_communities_csv(spark, f"{path}/list")


SQL_REJECTS = (
    SQL_TOP
    + """,
snap AS (
    SELECT CAST(o_orderdate AS DATE) AS snapshot_date, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS subreddit,
           CAST(o_orderkey AS VARCHAR) AS post_id, floor(o_totalprice) AS ups, o_orderstatus = 'P' AS deleted,
           o_orderpriority = '1-URGENT' AS timeless
    FROM orders
),
listed AS (
    SELECT *, row_number() OVER (PARTITION BY snapshot_date, subreddit ORDER BY ups DESC NULLS LAST, post_id) AS rn
    FROM snap WHERE subreddit IN (SELECT subreddit_name FROM top)
)
SELECT snapshot_date, subreddit, post_id, CASE WHEN deleted THEN 'no author' ELSE 'no time' END AS reason
FROM listed WHERE rn <= 100 AND (deleted OR timeless)"""
)


@register("ingest_rejects", "WITH" + SQL_REJECTS)
def q_ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listed posts that the ingest refuses: author deleted, or no creation time."""
    broken = standins.broken_post_snapshots(spark, sf_dir)
    _, rejected = ingest.ingest_posts(
        broken, standins.communities(spark, sf_dir), hot_order=standins.standin_hot_order(), with_rejected=True
    )
    reason = F.when(F.col("author_id").isNull(), "no author").otherwise("no time")
    return rejected.select("snapshot_date", "subreddit", "post_id", reason.alias("reason"))


@register("posts_written_back", "WITH" + SQL_POSTS + "\nSELECT * FROM posts", scenario=True)
def q_posts_written_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts of Q5 through the partitioned sink, one run twice, and the stored reader (K1)."""
    path = scratch_dir(spark, "posts_written_back")
    for _ in range(2):
        write_partitioned(_posts(spark, sf_dir), f"{path}/posts", mode="overwrite")
    return files.read_stored(spark, f"{path}/posts").select(*_posts(spark, sf_dir, []).columns)


@register("posts_ingest", "WITH" + SQL_POSTS + "\nSELECT * FROM posts")
def q_posts_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed day of posts for the top-25 communities, cleaned (Q5)."""
    return _posts(spark, sf_dir)


@register(
    "posts_cleaned",
    "WITH"
    + SQL_SNAP
    + """
SELECT nullif(post_id, '') AS post_id, nullif(created, 0) AS created,
       CAST(0 AS BIGINT) AS num_comments, nullif(ups, 0) AS ups, nullif(downs, 0) AS downs,
       CASE WHEN over_18 THEN true END AS over_18, nullif(author_id, '') AS author_id, subreddit
FROM snap""",
)
def q_posts_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Falsy -> missing and the comment-count default on every landed post."""
    cleaned = ingest.clean_posts(standins.post_snapshots(spark, sf_dir))
    return cleaned.select("post_id", "created", "num_comments", "ups", "downs", "over_18", "author_id", "subreddit")


@register(
    "ingest_counts",
    "WITH" + SQL_POSTS + "\nSELECT etl_date, subreddit, count(*) AS n_posts FROM posts GROUP BY 1, 2",
)
def q_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted posts per day and community (the jobs' load log, A5)."""
    return counts.count_per_group(_posts(spark, sf_dir), ["etl_date", "subreddit"], "n_posts")


SQL_COMMENTS = (
    SQL_POSTS
    + """,
keys AS (SELECT DISTINCT post_id, subreddit FROM posts WHERE post_id IS NOT NULL),
com AS (
    SELECT CAST(event_id // 10 AS VARCHAR) AS post_id,
           CAST(NULL AS VARCHAR) AS parent_id,
           CAST(event_id AS VARCHAR) AS comment_id,
           CAST(user_id AS VARCHAR) AS author_name,
           CAST(floor(value) AS BIGINT) AS score,
           CAST(epoch_us(ts) AS DOUBLE) / 1000000.0 AS created_utc,
           CAST(ts AS DATE) AS day,
           ts
    FROM events
)
SELECT com.post_id, com.parent_id,
       nullif(com.comment_id, '') AS comment_id,
       nullif(com.author_name, '') AS author_name,
       nullif(com.score, 0) AS score,
       nullif(com.created_utc, 0) AS created_utc,
       CAST(NULL AS BOOLEAN) AS is_submitter,
       CAST(NULL AS VARCHAR) AS distinguished,
       CAST(NULL AS VARCHAR) AS edited,
       CAST(NULL AS BIGINT) AS replies,
       CAST(epoch_us(CAST(com.day AS TIMESTAMP)) AS DOUBLE) / 1000000.0 AS etl_ts,
       keys.subreddit,
       com.day AS etl_date
FROM com JOIN keys ON keys.post_id = com.post_id"""
)


@register("comments_ingest", "WITH" + SQL_COMMENTS)
def q_comments_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments under the stored posts of the top-25 communities, every day (Q6)."""
    return _comments(spark, sf_dir)


JOIN_BUCKETS = 8


@register("comments_ingest_bucketed", "WITH" + SQL_COMMENTS, scenario=True)
def q_comments_ingest_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 from posts and comments stored in buckets of the post id: no side is shuffled."""
    path = scratch_dir(spark, "comments_ingest_bucketed")
    communities = standins.communities(spark, sf_dir)
    names = ingest.top_names(communities, ingest.TOP_COMMUNITIES)
    posts = ingest.bucket_by_post(_posts(spark, sf_dir, names), _view("posts"), JOIN_BUCKETS, f"{path}/posts")
    comments = ingest.bucket_by_post(
        standins.comment_snapshots(spark, sf_dir), _view("comments"), JOIN_BUCKETS, f"{path}/comments"
    )
    return ingest.ingest_comments(comments, posts, communities, names=names)


@register(
    "falsy_to_null",
    """
SELECT CAST(event_id AS VARCHAR) AS comment_id,
       nullif(CAST(user_id AS VARCHAR), '') AS author_name,
       nullif(CAST(floor(value) AS BIGINT), 0) AS score,
       nullif(CAST(epoch_us(ts) AS DOUBLE) / 1000000.0, 0) AS created_utc,
       CAST(NULL AS BOOLEAN) AS is_submitter,
       CAST(NULL AS VARCHAR) AS edited,
       CAST(NULL AS BIGINT) AS replies
FROM events""",
)
def q_falsy_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment cleaning on every landed comment: 0, '', false -> missing."""
    cleaned = ingest.clean_comments(standins.comment_snapshots(spark, sf_dir))
    return cleaned.select("comment_id", "author_name", "score", "created_utc", "is_submitter", "edited", "replies")


COMMENT_DAY = "2024-01-08"


@register(
    "comments_for_day",
    "WITH"
    + SQL_COMMENTS
    + """
WHERE com.ts >= TIMESTAMP '2024-01-08 00:00:00' AND com.ts < TIMESTAMP '2024-01-09 00:00:00'""",
)
def q_comments_for_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily comment run for one day: the day window reaches the events scan."""
    return _comments(spark, sf_dir, COMMENT_DAY)


@register(
    "reply_counts",
    """
WITH n AS (
    SELECT conv_id, turn - 1 AS turn, count(*) AS c FROM conversations WHERE turn > 0 GROUP BY 1, 2
)
SELECT CAST(t.conv_id AS VARCHAR) AS post_id,
       CAST(t.conv_id AS VARCHAR) || ':' || CAST(t.turn AS VARCHAR) AS comment_id,
       nullif(n.c, 0) AS replies
FROM conversations t LEFT JOIN n ON n.conv_id = t.conv_id AND n.turn = t.turn""",
)
def q_reply_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct replies per comment of the reply tree, 0 as missing."""
    return counts.reply_counts(standins.reply_tree(spark, sf_dir))


# Comment trees as landed: conversation c is post c, turn n answers turn (n - 1) // 2.
SQL_TREES = (
    SQL_TOP
    + """,
every AS (
    SELECT CAST(conv_id AS VARCHAR) AS post_id, turn,
           CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS comment_id,
           CASE WHEN turn > 0 THEN CAST(conv_id AS VARCHAR) || ':' || CAST((turn - 1) // 2 AS VARCHAR) END AS parent_id,
           role AS author_name, turn % 3 AS score
    FROM conversations
),
n AS (SELECT parent_id AS comment_id, count(*) AS replies FROM every WHERE turn > 0 GROUP BY 1)"""
)


@register(
    "comment_trees_ingest",
    "WITH"
    + SQL_TREES
    + """
SELECT e.post_id, e.parent_id, e.comment_id, e.author_name, nullif(e.score, 0) AS score,
       1704672000.0 + e.turn AS created_utc, CAST(NULL AS BOOLEAN) AS is_submitter, CAST(NULL AS VARCHAR) AS distinguished,
       CAST(NULL AS VARCHAR) AS edited, n.replies AS replies, 1704672000.0 AS etl_ts,
       'c' || CAST(CAST(e.post_id AS BIGINT) % 7 AS VARCHAR) AS subreddit, DATE '2024-01-08' AS etl_date
FROM every e LEFT JOIN n ON n.comment_id = e.comment_id""",
)
def q_comment_trees_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested comment trees of unknown depth, flattened and ingested with their reply counts."""
    trees = standins.comment_trees(spark, sf_dir)
    posts = standins.tree_posts(trees)
    communities = posts.groupBy("subreddit").agg(F.count("*").cast("double").alias("subscribers_count"))
    return ingest.ingest_comments(
        comment_trees.flat_comments(trees).drop("depth"), posts, communities.withColumnRenamed("subreddit", "subreddit_name")
    )


# --------------------------------------------------------------------------
# Content flag (Q7 batch and stream) and the sample post JSON (Q8).

SQL_FLAGS = """
WITH pf AS (
    SELECT CAST(doc_id AS VARCHAR) AS thread_id, bool_or(toxic = 1) AS post_adult
    FROM labels GROUP BY doc_id
),
cf AS (
    SELECT d.source AS subreddit, (coalesce(sum(l.toxic), 0) + 1) / (count(l.toxic) + 10) >= 0.15 AS community_adult
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id
    GROUP BY d.source
)
SELECT d.source AS subreddit,
       CAST(d.doc_id AS VARCHAR) AS thread_id,
       CAST(NULL AS VARCHAR) AS author_id,
       CAST(NULL AS VARCHAR) AS creation_date,
       CAST(NULL AS VARCHAR) AS url,
       CASE WHEN pf.post_adult IS NULL THEN NULL
            ELSE pf.post_adult AND NOT coalesce(cf.community_adult, false) END AS is_violation
FROM documents d
LEFT JOIN pf ON pf.thread_id = CAST(d.doc_id AS VARCHAR)
LEFT JOIN cf ON cf.subreddit = d.source"""


@register("content_flag_batch", SQL_FLAGS)
def q_content_flag_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adult post in a non-adult community, over every post event (Q7, batch)."""
    return moderation.apply_content_flag(
        standins.post_events(spark, sf_dir),
        standins.post_flags(spark, sf_dir),
        standins.community_flags(spark, sf_dir),
    )


@register("content_flag_sql", SQL_FLAGS)
def q_content_flag_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 in Spark SQL with the flag rule as a registered SQL function."""
    fn = moderation.register_flag_function(spark)
    events, posts, communities = _view("events"), _view("post_flags"), _view("community_flags")
    standins.post_events(spark, sf_dir).createOrReplaceTempView(events)
    standins.post_flags(spark, sf_dir).createOrReplaceTempView(posts)
    standins.community_flags(spark, sf_dir).createOrReplaceTempView(communities)
    return spark.sql(
        f"""
        SELECT e.subreddit, e.thread_id, e.author_id, e.creation_date, e.url,
               {fn}(p.post_adult, c.community_adult) AS is_violation
        FROM {events} e
        LEFT JOIN {posts} p ON p.thread_id = e.thread_id
        LEFT JOIN {communities} c ON c.subreddit = e.subreddit
        """
    )


@register("content_flag_stream", SQL_FLAGS)
def q_content_flag_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 as a Structured Streaming job over JSON event texts, read back.

    A producer step lands the post events as JSON lines (what a topic would
    hold); the stream decodes them with ``from_json`` by the declared schema,
    applies the flag lookups and writes JSON lines through the file sink with
    a checkpoint.
    """
    out = scratch_dir(spark, "content_flag_stream")
    events = standins.post_events(spark, sf_dir)
    events.select(encode_json(events.columns).alias("value")).write.text(f"{out}/in")
    parsed = content_flag.parse_events(content_flag.read_event_values(spark, "json", f"{out}/in"))
    query = content_flag.start_sink(
        content_flag.flag_events(
            content_flag.good_events(parsed),
            standins.post_flags(spark, sf_dir),
            standins.community_flags(spark, sf_dir),
        ),
        sink="json",
        path=f"{out}/data",
        checkpoint=f"{out}/checkpoint",
        available_now=True,
    )
    query.awaitTermination()
    return spark.read.schema(POST_EVENT).json(f"{out}/data")


def _land_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """A producer's step: events as JSON lines, what a topic would hold."""
    events.select(encode_json(events.columns).alias("value")).write.mode(mode).text(path)


@register(
    "content_flag_current",
    """
WITH loads AS (
    SELECT 1 AS load, CAST(doc_id AS VARCHAR) AS thread_id, toxic = 1 AS adult FROM labels WHERE quality = 1
    UNION ALL
    SELECT 2, CAST(doc_id AS VARCHAR), toxic = 1 FROM labels
),
pf AS (SELECT load, thread_id, bool_or(adult) AS post_adult FROM loads GROUP BY load, thread_id),
cf AS (
    SELECT d.source AS subreddit, (coalesce(sum(l.toxic), 0) + 1) / (count(l.toxic) + 10) >= 0.15 AS community_adult
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id
    GROUP BY d.source
),
ev AS (
    SELECT source AS subreddit, CAST(doc_id AS VARCHAR) AS thread_id,
           CASE WHEN lang = 'en' THEN 1 ELSE 2 END AS load
    FROM documents
)
SELECT ev.subreddit, ev.thread_id,
       CAST(NULL AS VARCHAR) AS author_id, CAST(NULL AS VARCHAR) AS creation_date, CAST(NULL AS VARCHAR) AS url,
       CASE WHEN pf.post_adult IS NULL THEN NULL
            ELSE pf.post_adult AND NOT (ev.load = 2 AND coalesce(cf.community_adult, false)) END AS is_violation
FROM ev
LEFT JOIN pf ON pf.load = ev.load AND pf.thread_id = ev.thread_id
LEFT JOIN cf ON cf.subreddit = ev.subreddit""",
    scenario=True,
)
def q_content_flag_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 on a running stream whose lookups are replaced while it runs.

    The English posts' events arrive first, when the store holds the flags of the good
    documents and no community flag; then both lookup folders are replaced and the other
    events arrive.  Each event is flagged by what is stored when its batch runs.
    """
    out = scratch_dir(spark, "content_flag_current")
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "source", "lang"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    english = F.coalesce(F.col("lang") == "en", F.lit(False))

    def store(flags: DataFrame, communities: DataFrame) -> None:
        flags.select(F.col("doc_id").cast("string").alias("post_id"), (F.col("toxic") == 1).alias("over_18")).write.mode(
            "overwrite"
        ).parquet(f"{out}/posts")
        communities.write.mode("overwrite").parquet(f"{out}/communities")

    communities = standins.community_flags(spark, sf_dir)
    store(labels.where("quality = 1"), communities.limit(0))
    _land_events(standins.post_events_from_documents(docs.where(english)), f"{out}/in")
    parsed = content_flag.parse_events(content_flag.read_event_values(spark, "json", f"{out}/in"))
    query = content_flag.start_current_flags(
        content_flag.good_events(parsed), content_flag.stored_lookups(f"{out}/posts", f"{out}/communities"),
        sink="json", path=f"{out}/data", checkpoint=f"{out}/checkpoint", processing_time="100 milliseconds",
    )
    try:
        query.processAllAvailable()
        store(labels, communities)
        _land_events(standins.post_events_from_documents(docs.where(~english)), f"{out}/in")
        query.processAllAvailable()
    finally:
        query.stop()
    return content_flag.read_flagged(spark, f"{out}/data")


# Event times of the de-duplicated stream, by language: old, in a wrong unit, missing,
# unreadable; the rest far beyond any calendar.
_EVENT_TIMES = {"en": "1704672000.0", "de": "1e12", "fr": None, "es": "soon"}
_FAR_TIME = "1e300"


@register(
    "stream_dedup",
    """
WITH ev AS (
    SELECT source AS subreddit, CAST(doc_id AS VARCHAR) AS thread_id,
           CASE lang WHEN 'en' THEN '1704672000.0' WHEN 'de' THEN '1e12' WHEN 'fr' THEN NULL WHEN 'es' THEN 'soon'
                ELSE '1e300' END AS creation_date
    FROM documents
)
SELECT DISTINCT subreddit, thread_id, creation_date FROM ev
UNION ALL
SELECT DISTINCT subreddit, 'again-' || thread_id, '1704672000.0' FROM ev""",
    scenario=True,
)
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once, whatever its clock says (G4): old, untimed and far-future events
    arrive with repeats, then all of them again beside new ones."""
    out = scratch_dir(spark, "stream_dedup")
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "source", "lang"])
    time_text = F.when(F.lit(False), F.lit(None).cast("string"))
    for lang, text in _EVENT_TIMES.items():
        time_text = time_text.when(F.col("lang") == lang, F.lit(text).cast("string"))
    timed = docs.withColumn("creation_date", time_text.otherwise(_FAR_TIME))
    first = standins.post_events_from_documents(timed, creation_date="creation_date")
    again = first.withColumn("thread_id", F.concat(F.lit("again-"), "thread_id")).withColumn("creation_date", F.lit(_EVENT_TIMES["en"]))
    for landed in (first.unionByName(first), first.unionByName(again)):
        _land_events(landed, f"{out}/in")
        parsed = content_flag.parse_events(content_flag.read_event_values(spark, "json", f"{out}/in"))
        deduped = content_flag.dedupe_events(content_flag.good_events(parsed))
        content_flag.start_sink(
            deduped, sink="json", path=f"{out}/data", checkpoint=f"{out}/checkpoint", available_now=True
        ).awaitTermination()
    return spark.read.schema(POST_EVENT).json(f"{out}/data").select("subreddit", "thread_id", "creation_date")


@register(
    "sample_post_json",
    "WITH"
    + SQL_SNAP
    + """,
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY ups DESC NULLS LAST, post_id) AS rn,
           count(*) OVER (PARTITION BY subreddit) AS n
    FROM snap
)
SELECT subreddit,
       CAST(json_object('subreddit', subreddit, 'thread_id', post_id, 'author_id', author_id,
                        'creation_date', CAST(CAST(created AS BIGINT) AS VARCHAR) || '.0',
                        'url', CAST(NULL AS VARCHAR)) AS VARCHAR) AS sample_json
FROM ranked WHERE rn = least(n, 10)""",
)
def q_sample_post_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per community, the last of its first 10 hot posts as a JSON event (Q8)."""
    snaps = standins.post_snapshots(spark, sf_dir).select("subreddit", "post_id", "author_id", "created", "url", "ups")
    return moderation.sample_post_json(snaps, standins.standin_hot_order())

"""Activity kept across loads: week masks, user bitmaps and runs of days that merge.

Each table here is a summary that a day's load updates without a scan of the history,
and each is published run by run (``sinks.published``), so a reload of a day changes
nothing and a killed load is invisible:

* week masks: a run for each week; a load ORs its days into the masks of that week only;
* users: a number for each author, given once (a run for each load that brought new
  ones); the numbers are dense, so bitmaps stay small;
* day bitmaps: a run for each load; a bitmap holds 32,768 users.  Active users of any span
  are the set bits of the OR over its days: no distinct count, no scan of the comments;
* run summaries: (first run, last run, longest) of an author's days in a period.  They
  merge over periods in order of time, associatively, so weeks make months and months
  years, and no set of days over all history is built.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.functions.dates import week_start
from agora.operators.activity import MISSING_AUTHOR
from agora.operators.ranking import numbered
from agora.sinks.published import Entry, entries, live, publish_run, read_published

MASKS = "author_id string, mask int"
USERS = "author_id string, user_no long"
BITMAPS = "bucket long, users binary, day date"


def present(staging: DataFrame, user_col: str = "author_id", day_col: str = "etl_ts") -> DataFrame:
    """``author_id, day`` of the rows that the reports count."""
    rows = staging.select(F.col(user_col).alias("author_id"), F.col(day_col).alias("day"))
    return rows.where((F.col("author_id") != F.lit(MISSING_AUTHOR)) & F.col("day").isNotNull())


def _days(rows: DataFrame, day: Column) -> list[dt.date]:
    """The distinct days (or weeks) of a load; bounded by the calendar."""
    return sorted(r[0] for r in rows.select(day.alias("d")).distinct().collect())


# ---- week masks (A2, Q1-Q3)


def add_to_week_masks(staging: DataFrame, path: str) -> list[Entry]:
    """OR a load's rows into the masks of the weeks they fall in.

    Reads the masks of those weeks and the load, nothing else.  A mask is a set, so the
    rows of a repeated load change nothing.
    """
    spark, rows = staging.sparkSession, present(staging)
    bit = F.expr("shiftleft(1, datediff(day, date_trunc('week', day)))")
    new = rows.select("author_id", week_start("day").alias("week"), bit.alias("mask"))
    out = []
    for monday in _days(rows, week_start("day")):
        days = monday.isoformat(), (monday + dt.timedelta(days=7)).isoformat()
        old = read_published(spark, path, "masks", MASKS, days)
        of_week = new.where(F.col("week") == F.lit(monday)).select("author_id", "mask")
        merged = old.unionByName(of_week).groupBy("author_id").agg(F.bit_or("mask").alias("mask"))
        out.append(publish_run(path, days[0], *days, {"masks": merged}))
    return out


def week_masks(spark: SparkSession, path: str, monday: dt.date) -> DataFrame:
    """``author_id, mask`` of the week, for the reports' ``masks=``."""
    return read_published(spark, path, "masks", MASKS, (monday.isoformat(), (monday + dt.timedelta(days=7)).isoformat()))


# ---- users and their day bitmaps


def number_new_users(staging: DataFrame, path: str, run: str) -> DataFrame:
    """Give a number to each author that has none yet; returns all (author_id, user_no).

    New authors are numbered by ranges, behind the numbers given before; the manifest
    knows how many those are.
    """
    spark = staging.sparkSession
    known = read_published(spark, path, "users", USERS)
    new = present(staging).select("author_id").distinct().join(known, "author_id", "left_anti")
    base = sum(e.rows["users"] for e in live(entries(spark, path)))
    fresh = numbered(new, ["author_id"], "n").select("author_id", (F.col("n") + F.lit(base)).alias("user_no"))
    # numbers are never taken back: each load's new ones stand beside the earlier ones
    entry = publish_run(path, f"{run}-from-{base}", "", "", {"users": fresh})
    return read_published(spark, path, "users", USERS) if entry.rows["users"] else known


def add_bitmaps(staging: DataFrame, users: DataFrame, path: str, first: str, end: str) -> Entry:
    """The bitmaps of a load over the days [first, end), a folder for each day.

    A run that covers earlier ones takes their place (a day loaded again, a backfill), so
    a load must hold all rows of its days; rows of other days are refused.
    """
    rows = present(staging)
    if rows.where(~((F.col("day") >= F.lit(first).cast("date")) & (F.col("day") < F.lit(end).cast("date")))).head(1):
        raise ValueError(f"the load has rows outside [{first}, {end})")
    maps = rows.join(users, "author_id").groupBy("day", F.bitmap_bucket_number("user_no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("users")
    )
    return publish_run(path, f"{first}_{end}", first, end, {"bitmaps": maps}, {"bitmaps": ["day"]})


def day_bitmaps(spark: SparkSession, path: str) -> DataFrame:
    return read_published(spark, path, "bitmaps", BITMAPS)


def active_users(bitmaps: DataFrame, spans: tuple[int, ...] = (1, 7, 28)) -> DataFrame:
    """``day, active_<span>...``: distinct users of the last ``span`` days, for each day with
    a bitmap, from the day table alone.

    A day's bitmap goes to each report day it counts for (the longest span bounds that);
    bitmaps of a bucket meet by OR, with a partial OR before the exchange.
    """
    reported = bitmaps.select(F.col("day").alias("report_day")).distinct()
    ahead = F.explode(F.sequence(F.lit(0), F.lit(max(spans) - 1)))
    lent = bitmaps.select("bucket", "users", "day", ahead.alias("ago"))
    lent = lent.select("bucket", "users", "ago", F.date_add("day", F.col("ago")).alias("report_day"))
    per = lent.groupBy("report_day", "bucket").agg(
        *[F.bitmap_count(F.bitmap_or_agg(F.when(F.col("ago") < s, F.col("users")))).alias(f"n{s}") for s in spans]
    )
    total = per.groupBy("report_day").agg(*[F.sum(f"n{s}").alias(f"active_{s}") for s in spans])
    return total.join(reported, "report_day", "left_semi").withColumnRenamed("report_day", "day")


# ---- runs of days that merge

RUNS = "struct<first:date,first_end:date,last_start:date,last:date,longest:int>"


def _length(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1


def merged_runs(a: Column, b: Column) -> Column:
    """The summary of two stretches of time, all days of ``a`` before those of ``b``.

    Associative; a null ``a`` is the empty summary.
    """
    touch = F.date_add(a["last"], 1) == b["first"]
    one_a, one_b = a["first"] == a["last_start"], b["first"] == b["last_start"]
    both = F.struct(
        a["first"].alias("first"),
        F.when(touch & one_a, b["first_end"]).otherwise(a["first_end"]).alias("first_end"),
        F.when(touch & one_b, a["last_start"]).otherwise(b["last_start"]).alias("last_start"),
        b["last"].alias("last"),
        F.greatest(
            a["longest"], b["longest"], F.when(touch, _length(a["last_start"], b["first_end"])).otherwise(F.lit(0))
        ).alias("longest"),
    )
    return F.when(a.isNull(), b).otherwise(both)


def period_runs(staging: DataFrame, period: Column) -> DataFrame:
    """``author_id, period, runs`` of each author's days in a period (an expression over
    ``day``).  The day set of a (author, period) is bounded by the period's days."""
    rows = present(staging).withColumn("period", period)
    days = rows.groupBy("author_id", "period").agg(F.array_sort(F.collect_set("day")).alias("days"))
    ones = F.transform("days", lambda x: F.struct(*[x.alias(n) for n in ("first", "first_end", "last_start", "last")], F.lit(1).alias("longest")))
    return days.select("author_id", "period", _fold(ones).alias("runs"))


def _fold(summaries: Column) -> Column:
    return F.aggregate(summaries, F.lit(None).cast(RUNS), lambda a, b: merged_runs(a, b).cast(RUNS))


def combined_runs(runs: DataFrame, period: Column | None = None) -> DataFrame:
    """Merge summaries into those of longer periods (an expression over ``period``), or of
    all time.  A group holds one summary for each shorter period in it."""
    keys = ["author_id"]
    if period is not None:
        runs, keys = runs.withColumn("period", period), ["author_id", "period"]
    # by first day: periods do not overlap
    gathered = runs.groupBy(*keys).agg(F.array_sort(F.collect_list("runs")).alias("runs"))
    return gathered.select(*keys, _fold(F.col("runs")).alias("runs"))


def longest_streaks(runs: DataFrame) -> DataFrame:
    """``author_id, longest_streak`` from summaries of all time."""
    return runs.select("author_id", F.col("runs.longest").cast("bigint").alias("longest_streak"))

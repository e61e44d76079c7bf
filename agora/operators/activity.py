"""Weekly activity mask per user.

Two plans that give the same masks:

* ``week_masks`` - one aggregate: ``bit_or(1 << (day - monday))`` grouped by
  user.  Partial aggregation combines map-side, so the shuffle carries one
  row per (task, user) no matter how many events a hot user has; there is no
  day array, no calendar and no row blow-up.
* ``week_masks_literal`` - the report's own shape: distinct day set per user,
  a 7-day calendar generated per user (``explode(sequence(...))``), a power of
  two per calendar day found in the set, summed into a 32-bit value whose top
  7 bits are the week.  Kept as the parity form and for the bench.

Week selection follows the reports: ``weekofyear(day) = week`` with no year
test.  With data from several years, users active only in that week number of
another year appear with mask 0 (as the reports do).  ``prune=True`` instead
selects the 7 dates of the requested week - a range the Parquet scan can
skip on - and such users are absent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.functions.bits import day_bit
from agora.functions.dates import iso_week, iso_week_monday

# Missing-author sentinel written by the staging load (Python's str(None)).
MISSING_AUTHOR = "None"
# The reports' week (fixed values): ISO week 2 of 2024, Monday 2024-01-08.
REPORT_YEAR = 2024
REPORT_WEEK = 2


def select_week(
    staging: DataFrame,
    year: int = REPORT_YEAR,
    week: int = REPORT_WEEK,
    prune: bool = False,
    user_col: str = "author_id",
    day_col: str = "etl_ts",
) -> DataFrame:
    """Staging rows of the week, without the missing-author sentinel."""
    monday = iso_week_monday(year, week)
    if prune:
        in_week = F.col(day_col).between(F.lit(monday), F.lit(monday + dt.timedelta(days=6)))
    else:
        in_week = iso_week(day_col) == F.lit(week)
    return staging.where(in_week & (F.col(user_col) != F.lit(MISSING_AUTHOR)))


def week_masks(
    staging: DataFrame,
    year: int = REPORT_YEAR,
    week: int = REPORT_WEEK,
    prune: bool = False,
    user_col: str = "author_id",
    day_col: str = "etl_ts",
) -> DataFrame:
    """``user_col, mask``: mask bit d set when the user was active on monday + d."""
    monday = iso_week_monday(year, week)
    rows = select_week(staging, year, week, prune, user_col, day_col)
    return rows.groupBy(user_col).agg(F.bit_or(day_bit(day_col, monday)).alias("mask"))


def week_masks_literal(
    staging: DataFrame,
    year: int = REPORT_YEAR,
    week: int = REPORT_WEEK,
    prune: bool = False,
    user_col: str = "author_id",
    day_col: str = "etl_ts",
) -> DataFrame:
    """``user_col, weekly_activity_bin, mask`` via day set + calendar + sum of powers."""
    monday = iso_week_monday(year, week)
    sunday = monday + dt.timedelta(days=6)
    days = (
        select_week(staging, year, week, prune, user_col, day_col)
        .groupBy(user_col)
        .agg(F.collect_set(day_col).alias("active_days"))
    )
    calendar = days.select(
        user_col,
        "active_days",
        F.explode(F.sequence(F.lit(monday), F.lit(sunday), F.expr("INTERVAL 1 DAY"))).alias("eow_date"),
    )
    powered = calendar.withColumn(
        "pow_2", F.pow(F.lit(2.0), F.lit(31) - F.datediff(F.lit(sunday), F.col("eow_date")))
    )
    summed = powered.groupBy(user_col).agg(
        F.sum(F.when(F.array_contains("active_days", F.col("eow_date")), F.col("pow_2")).otherwise(0.0))
        .cast("bigint")
        .alias("bin_value")
    )
    return summed.select(
        user_col,
        F.lpad(F.bin(F.col("bin_value").bitwiseAND(F.lit(0xFFFFFFFF))), 32, "0").alias("weekly_activity_bin"),
        F.shiftright(F.col("bin_value"), 25).bitwiseAND(F.lit(127)).cast("int").alias("mask"),
    )

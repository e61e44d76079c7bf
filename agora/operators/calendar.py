"""Weeks of a day-partitioned table through a calendar dimension.

The calendar has one row a day, so its size is bounded by the years it spans (47,000 rows
for 130 years) and it is broadcast.  A table partitioned by day, joined to some of its
rows, is pruned at run time: the scan lists and reads the folders of those days only
(dynamic partition pruning), whatever the condition on the calendar is - one week of one
year, or week 2 of every year as the reports have it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.functions.dates import iso_week, iso_week_monday, week_start
from agora.operators.activity import MISSING_AUTHOR, REPORT_WEEK, REPORT_YEAR

FIRST, LAST = dt.date(1970, 1, 1), dt.date(2099, 12, 31)


def calendar(spark: SparkSession, first: dt.date = FIRST, last: dt.date = LAST) -> DataFrame:
    """``day, week_start, iso_week, bit``: a row a day; bit 0 is the week's Monday."""
    epoch = dt.date(1970, 1, 1)
    days = spark.range((first - epoch).days, (last - epoch).days + 1).select(F.date_from_unix_date(F.col("id").cast("int")).alias("day"))
    monday = week_start("day")
    return days.select(
        "day", monday.alias("week_start"), iso_week("day").alias("iso_week"),
        F.expr("shiftleft(1, datediff(day, date_trunc('week', day)))").alias("bit"),
    )


def days_of_week(spark: SparkSession, year: int = REPORT_YEAR, week: int = REPORT_WEEK, every_year: bool = True) -> DataFrame:
    """``day, bit`` of the week.  ``every_year`` (the reports' rule) has the days of that
    week number in all years, those of other years with bit 0."""
    monday = F.lit(iso_week_monday(year, week))
    days = calendar(spark).where(F.col("iso_week") == F.lit(week))
    own = F.col("week_start") == monday
    if not every_year:
        days = days.where(own)
    return days.select("day", F.when(own, F.col("bit")).otherwise(F.lit(0)).alias("bit"))


def week_masks_of_days(
    staging: DataFrame,
    year: int = REPORT_YEAR,
    week: int = REPORT_WEEK,
    every_year: bool = True,
    user_col: str = "author_id",
    day_col: str = "etl_ts",
) -> DataFrame:
    """``user_col, mask`` as ``activity.week_masks``, from a table partitioned by ``day_col``."""
    days = F.broadcast(days_of_week(staging.sparkSession, year, week, every_year))  # at most seven days a year
    rows = staging.where(F.col(user_col) != F.lit(MISSING_AUTHOR)).join(days, F.col(day_col) == F.col("day"))
    return rows.groupBy(user_col).agg(F.bit_or("bit").cast("int").alias("mask"))

"""Weekly activity reports, read from the user-by-day staging table.

All three reports share one mask sub-plan (``week_masks``).  When several of
them run in the same job, pass ``masks=`` to reuse one computed mask frame.

Outputs (names fixed by the reports):

* ``weekly_active_days``   author_id, user_num_active_in_week
* ``weekly_activity_rate`` author_id, weekly_activity, avg_activity_rate_per_week
* ``consecutive_day_flags`` author_id, weekly_activity,
  is_active_7_consecutive_days, is_active_6_consecutive_days,
  is_active_5_consecutive_days

Beyond the reports: ``longest_streak`` (true longest run of active days) and
``weekly_active_users`` (distinct active users per ISO week).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.functions.bits import mask_has, popcount, week_mask_string
from agora.functions.dates import iso_week, week_start
from agora.operators.activity import (
    MISSING_AUTHOR,
    REPORT_WEEK,
    REPORT_YEAR,
    week_masks,
    week_masks_literal,
)

# Day patterns of the consecutive-day flags (fixed values; Sunday first).
# A flag is set when the week contains every '1' of any of its patterns.
SEVEN_DAY_PATTERNS = ("1111111",)
SIX_DAY_PATTERNS = ("1111110", "0111111")
FIVE_DAY_PATTERNS = ("1111101", "1011111")


def _masks(staging: DataFrame | None, masks: DataFrame | None, literal: bool, **week) -> DataFrame:
    if masks is not None:
        return masks
    build = week_masks_literal if literal else week_masks
    return build(staging, **week)


def weekly_active_days(
    staging: DataFrame | None = None,
    year: int = REPORT_YEAR,
    week: int = REPORT_WEEK,
    prune: bool = False,
    literal: bool = False,
    masks: DataFrame | None = None,
) -> DataFrame:
    m = _masks(staging, masks, literal, year=year, week=week, prune=prune)
    return m.select("author_id", popcount("mask").alias("user_num_active_in_week"))


def weekly_activity_rate(
    staging: DataFrame | None = None,
    year: int = REPORT_YEAR,
    week: int = REPORT_WEEK,
    prune: bool = False,
    literal: bool = False,
    masks: DataFrame | None = None,
) -> DataFrame:
    m = _masks(staging, masks, literal, year=year, week=week, prune=prune)
    return m.select(
        "author_id",
        week_mask_string("mask").alias("weekly_activity"),
        F.round(popcount("mask") / F.lit(7.0), 2).alias("avg_activity_rate_per_week"),
    )


def _any_pattern(patterns: tuple[str, ...]):
    cond = None
    for p in patterns:
        c = mask_has("mask", p)
        cond = c if cond is None else (cond | c)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def consecutive_day_flags(
    staging: DataFrame | None = None,
    year: int = REPORT_YEAR,
    week: int = REPORT_WEEK,
    prune: bool = False,
    literal: bool = False,
    masks: DataFrame | None = None,
) -> DataFrame:
    """Flags read from the week mask.

    Parity note: the "5" flag is set by a run of five days *plus one separate
    day* (patterns above); a bare run of five sets none of the flags.
    ``longest_streak`` gives the true run length.
    """
    m = _masks(staging, masks, literal, year=year, week=week, prune=prune)
    return m.select(
        "author_id",
        week_mask_string("mask").alias("weekly_activity"),
        _any_pattern(SEVEN_DAY_PATTERNS).alias("is_active_7_consecutive_days"),
        _any_pattern(SIX_DAY_PATTERNS).alias("is_active_6_consecutive_days"),
        _any_pattern(FIVE_DAY_PATTERNS).alias("is_active_5_consecutive_days"),
    )


def longest_streak(staging: DataFrame, user_col: str = "author_id", day_col: str = "etl_ts") -> DataFrame:
    """``author_id, longest_streak``: longest run of consecutive active days.

    One exchange: the distinct active days of each user are gathered by a
    partial ``collect_set`` (each map task sends one set per user, so a hot
    user is collapsed map-side, and a set holds at most one entry per calendar
    day - bounded by the calendar, not by the user's events).  The longest run
    is then folded over the sorted days with a higher-order ``aggregate``: a
    day extends the current run when it follows the previous one.
    """
    days = (
        staging.where((F.col(user_col) != F.lit(MISSING_AUTHOR)) & F.col(day_col).isNotNull())
        .groupBy(user_col)
        .agg(F.array_sort(F.collect_set(day_col)).alias("_days"))
    )
    start = F.struct(
        F.lit(None).cast("date").alias("prev"), F.lit(0).alias("run"), F.lit(0).alias("best")
    )

    def step(acc, day):
        run = F.when(F.date_add(acc["prev"], 1) == day, acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(day.alias("prev"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    best = F.aggregate("_days", start, step, lambda acc: acc["best"])
    return days.select(F.col(user_col).alias("author_id"), best.cast("bigint").alias("longest_streak"))


def weekly_active_users(staging: DataFrame, user_col: str = "author_id", day_col: str = "etl_ts") -> DataFrame:
    """``week_start, iso_week, active_users`` for every week in the staging table.

    Keyed by the Monday of the week, so weeks of different years stay apart.
    The distinct count is planned as (week, user) de-duplication with partial
    aggregation, then a count per week.
    """
    rows = staging.where((F.col(user_col) != F.lit(MISSING_AUTHOR)) & F.col(day_col).isNotNull())
    return (
        rows.groupBy(week_start(day_col).alias("week_start"))
        .agg(F.count_distinct(user_col).alias("active_users"))
        .select("week_start", iso_week("week_start").alias("iso_week"), "active_users")
    )


REPORT_BUILDERS = {
    "active_days": weekly_active_days,
    "activity_rate": weekly_activity_rate,
    "consecutive_days": consecutive_day_flags,
}


def write_all_reports(
    staging: DataFrame,
    out_dir: str,
    year: int = REPORT_YEAR,
    week: int = REPORT_WEEK,
    prune: bool = False,
    masks: DataFrame | None = None,
    names: list[str] | None = None,
) -> dict[str, str]:
    """Compute the week masks once (or take ``masks``) and write the reports (all three, or
    ``names``) from them.

    The masks (one narrow row per active user) are written as a table under
    ``out_dir/masks`` first; each report then reads that table.  The staging
    scan and the one shuffle run once instead of three times, and a lost
    executor re-reads the written masks instead of recomputing them.
    """
    masks_path = f"{out_dir.rstrip('/')}/masks"
    if masks is None:
        masks = week_masks(staging, year=year, week=week, prune=prune)
    masks.write.mode("overwrite").parquet(masks_path)
    masks = staging.sparkSession.read.parquet(masks_path)
    paths = {}
    for name, build in REPORT_BUILDERS.items():
        if names is not None and name not in names:
            continue
        path = f"{out_dir.rstrip('/')}/{name}"
        build(masks=masks).write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths

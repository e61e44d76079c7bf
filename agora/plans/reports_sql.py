"""The weekly reports as Spark SQL text, for users who run SQL files.

Each text reads a table or view named ``dim_all_users_stg`` (``author_id
STRING, etl_ts DATE``) and takes the report week as parameters.  They use the
single-aggregate mask (``bit_or``), so the plan is the same as the DataFrame
form: partial + final aggregate around one exchange on ``author_id``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from agora.functions.dates import iso_week_monday
from agora.operators.activity import REPORT_WEEK, REPORT_YEAR

STAGING_VIEW = "dim_all_users_stg"

_MASKS = """
WITH week_rows AS (
    SELECT author_id, etl_ts
    FROM {table}
    WHERE weekofyear(etl_ts) = {week}
      AND author_id <> 'None'
),
masks AS (
    SELECT author_id,
           bit_or(CASE WHEN datediff(etl_ts, DATE'{monday}') BETWEEN 0 AND 6
                       THEN shiftleft(1, datediff(etl_ts, DATE'{monday}'))
                       ELSE 0 END) AS mask
    FROM week_rows
    GROUP BY author_id
)
"""

ACTIVE_DAYS = (
    _MASKS
    + """
SELECT author_id, CAST(bit_count(mask) AS INT) AS user_num_active_in_week
FROM masks
"""
)

ACTIVITY_RATE = (
    _MASKS
    + """
SELECT author_id,
       lpad(bin(mask), 7, '0') AS weekly_activity,
       round(bit_count(mask) / 7.0D, 2) AS avg_activity_rate_per_week
FROM masks
"""
)

CONSECUTIVE_FLAGS = (
    _MASKS
    + """
SELECT author_id,
       lpad(bin(mask), 7, '0') AS weekly_activity,
       CASE WHEN mask & 127 = 127 THEN 1 ELSE 0 END AS is_active_7_consecutive_days,
       CASE WHEN mask & 126 = 126 OR mask & 63 = 63 THEN 1 ELSE 0 END AS is_active_6_consecutive_days,
       CASE WHEN mask & 125 = 125 OR mask & 95 = 95 THEN 1 ELSE 0 END AS is_active_5_consecutive_days
FROM masks
"""
)

REPORTS = {
    "active_days": ACTIVE_DAYS,
    "activity_rate": ACTIVITY_RATE,
    "consecutive_days": CONSECUTIVE_FLAGS,
}


def report_sql(name: str, year: int = REPORT_YEAR, week: int = REPORT_WEEK, table: str = STAGING_VIEW) -> str:
    monday: dt.date = iso_week_monday(year, week)
    return REPORTS[name].format(table=table, week=int(week), monday=monday.isoformat())


def run_report(
    spark: SparkSession,
    name: str,
    staging: DataFrame | None = None,
    year: int = REPORT_YEAR,
    week: int = REPORT_WEEK,
    view: str = STAGING_VIEW,
) -> DataFrame:
    """Run a report over the table or view ``view``.

    With ``staging`` that frame is first registered as ``view``; callers that
    may run concurrently in one session pass a view name of their own.
    """
    if staging is not None:
        staging.createOrReplaceTempView(view)
    return spark.sql(report_sql(name, year, week, table=view))

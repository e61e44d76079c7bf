"""Date and epoch helpers (ISO week, epoch seconds <-> UTC day).

Every helper assumes ``spark.sql.session.timeZone=UTC`` (set by
``agora.session``): the reference turns epoch seconds into UTC days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_week(day: Column | str) -> Column:
    """ISO-8601 week number (1..53) of a date; no year test, as in the reports."""
    return F.weekofyear(_col(day))


def iso_week_monday(year: int, week: int) -> dt.date:
    """Monday of ISO week ``week`` of ISO year ``year``."""
    return dt.date.fromisocalendar(year, week, 1)


def week_start(day: Column | str) -> Column:
    """Monday of the ISO week that contains ``day`` (keeps the year)."""
    return F.date_trunc("week", _col(day)).cast("date")


def epoch_to_date(epoch: Column | str) -> Column:
    """Epoch seconds (double) -> UTC calendar date."""
    return F.to_date(F.timestamp_seconds(_col(epoch)))


def epoch_to_day_text(epoch: Column | str) -> Column:
    """Epoch seconds -> 'yyyy-MM-dd' of the UTC day."""
    return F.date_format(F.timestamp_seconds(_col(epoch)), "yyyy-MM-dd")


def epoch_seconds(ts: Column | str) -> Column:
    """Timestamp (with or without zone) -> epoch seconds as DOUBLE.

    Driver parquet timestamps load as TIMESTAMP_NTZ; the cast to TIMESTAMP is
    read in the session zone, which is UTC.
    """
    return F.unix_micros(_col(ts).cast("timestamp")) / F.lit(1_000_000.0)


def day_bounds(day: dt.date) -> tuple[float, float]:
    """[midnight, next midnight) of a UTC day, as epoch seconds."""
    start = dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp()
    return start, start + SECONDS_PER_DAY


def day_window(epoch: Column | str, start: dt.date, end: dt.date | None = None) -> Column:
    """Half-open range ``start <= epoch < end`` on epoch seconds.

    ``end`` defaults to the day after ``start``.  Written as a plain range on the
    raw column, so the predicate reaches the Parquet scan (PushedFilters) where
    ``to_date(timestamp_seconds(x)) = d`` would not.
    """
    lo, _ = day_bounds(start)
    hi = day_bounds(end)[0] if end is not None else lo + SECONDS_PER_DAY
    c = _col(epoch)
    return (c >= F.lit(lo)) & (c < F.lit(hi))


def as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)

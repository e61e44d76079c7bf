"""Bit helpers for the weekly activity mask.

Layout (fixed by the reports): the mask is written as 7 characters, leftmost
= Sunday, rightmost = Monday.  As an integer 0..127 that is bit
``datediff(day, monday)``: Monday = 1, Tuesday = 2, ..., Sunday = 64, so
``lpad(bin(mask), 7, '0')`` gives the report's string directly.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEK_BITS = 7
FULL_WEEK = (1 << WEEK_BITS) - 1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_bit(day: Column | str, monday: dt.date) -> Column:
    """2^(day - monday) for a day inside the week starting ``monday``, else 0."""
    offset = F.datediff(_col(day), F.lit(monday))
    return (
        F.when((offset >= 0) & (offset < WEEK_BITS), F.call_function("shiftleft", F.lit(1), offset))
        .otherwise(F.lit(0))
        .cast("int")
    )


def bit_string(value: Column | str, width: int) -> Column:
    """Low ``width`` bits of an integer as a '0'/'1' string, most significant first."""
    low = _col(value).cast("bigint").bitwiseAND(F.lit((1 << width) - 1))
    return F.lpad(F.bin(low), width, "0")


def week_mask_string(mask: Column | str) -> Column:
    """7-character rendering of a week mask (Sunday first)."""
    return bit_string(mask, WEEK_BITS)


def popcount(value: Column | str) -> Column:
    """Number of set bits, as INT."""
    return F.bit_count(_col(value)).cast("int")


def mask_has(mask: Column | str, pattern: str) -> Column:
    """True when every '1' of the 7-character ``pattern`` is set in ``mask``."""
    bits = int(pattern, 2)
    return _col(mask).bitwiseAND(F.lit(bits)) == F.lit(bits)

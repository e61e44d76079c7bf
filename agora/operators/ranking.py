"""Ranks within groups and row numbers, for any group size and any limit.

``row_number`` over a group sorts the whole group in one task, and a limit helps only
while it is small.  Here the rows are dealt to ranges of (group, order): a group of any
size spreads over as many ranges as its share of the rows asks for.  A row's rank is the
number of its group's rows in earlier ranges (prefix sums of one count for each group and
range) plus its place in its own range.  With a limit, ranges that begin beyond it are
dropped by their counts alone, before any row moves again.

The dealt rows are written to the scratch folder first: ranges come from a sample, and
counts and ranks must see the same ones, also after a lost executor.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.session import scratch_dir

_RANGE, _BEFORE, _TIE = "_range", "_before", "_tie"


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def dealt(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], ranges: int | None = None) -> DataFrame:
    """``df`` with its range's number and a last sort key, written and read back.

    The last key keeps rows with equal order apart, so that ties spread as well.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn(_TIE, F.monotonically_increasing_id())
    path = f"{scratch_dir(spark, 'ranking')}/rows"
    # a given number of ranges is not coalesced
    keyed.repartitionByRange(n, *_cols([*group, *order]), F.col(_TIE)).withColumn(_RANGE, F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(keyed.withColumn(_RANGE, F.lit(0)).schema).parquet(path)


def ranked(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    rank_col: str,
    n: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Rows of ``df`` with their 1-based rank in the group (LONG), up to ``n`` if given.

    Equal to ``row_number`` where ``order`` is a total order; rows with equal order take
    the next ranks in some order.  A null group is a group.
    """
    rows = dealt(df, group, order, ranges)
    counts = rows.groupBy(*group, _RANGE).agg(F.count("*").alias("_n"))
    # at most one row for each group and range
    earlier = Window.partitionBy(*group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*group, _RANGE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(_BEFORE))
    if n is not None:
        before = before.where(F.col(_BEFORE) < F.lit(n))
    a, b = rows.alias("a"), before.alias("b")
    same = functools.reduce(operator.and_, [F.col(f"a.`{g}`").eqNullSafe(F.col(f"b.`{g}`")) for g in [*group, _RANGE]])
    met = a.join(b, same).select("a.*", F.col(f"b.{_BEFORE}"))
    place = Window.partitionBy(*group, _RANGE).orderBy(*_cols(order), _TIE)
    out = met.withColumn(rank_col, F.col(_BEFORE) + F.row_number().over(place)).drop(_TIE, _RANGE, _BEFORE)
    return out if n is None else out.where(F.col(rank_col) <= F.lit(n))


def numbered(df: DataFrame, order: Sequence[Column | str], number_col: str, ranges: int | None = None) -> DataFrame:
    """``df`` with the numbers 1, 2, ... of its rows by ``order``, in no single task."""
    return ranked(df.withColumn("_all", F.lit(0)), ["_all"], order, number_col, ranges=ranges).drop("_all")

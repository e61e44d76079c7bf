"""Top-N, first-N-per-group and last-of-first-N-per-group.

* ``top_n`` is a global ORDER BY + LIMIT: Spark plans TakeOrderedAndProject,
  each task keeps its own n best rows and only n x tasks rows reach the final
  merge - no full sort, no shuffle of the input.
* ``first_n_per_group`` filters ``row_number() <= n``.  For n up to
  ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000) Spark inserts a
  partial WindowGroupLimit *before* the shuffle, so a group holding a third of
  all rows still ships at most n rows per map task; the window then sorts
  only those survivors.  Above that threshold the ranks come from ranges
  (``operators.ranking``), so no group meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.operators.ranking import ranked

RANK_COL = "_rank"


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_n(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*_cols(order)).limit(n)


def top_communities(communities: DataFrame, n: int) -> DataFrame:
    """The ``n`` communities with most subscribers; unknown counts last.

    NaN is read as unknown (pandas sorts it last; Spark would rank NaN above
    every number), ties are broken by name so the pick repeats.
    """
    cleaned = communities.withColumn(
        "subscribers_count", F.nanvl(F.col("subscribers_count"), F.lit(None).cast("double"))
    )
    return top_n(
        cleaned,
        n,
        [F.col("subscribers_count").desc_nulls_last(), F.col("subreddit_name").asc()],
    )


def first_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    rank_col: str | None = None,
) -> DataFrame:
    """Rows ranked 1..n inside each group (by ``order``, ties by the order given).

    With ``rank_col`` the 1-based rank is kept in that column.
    """
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        rows = ranked(df, list(group), order, rank_col or RANK_COL, n)
        return rows.withColumn(rank_col, F.col(rank_col).cast("int")) if rank_col else rows.drop(RANK_COL)
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    name = rank_col or RANK_COL
    limited = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= F.lit(n))
    return limited if rank_col else limited.drop(name)


def last_of_first_n(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    n: int,
    fields: Sequence[str],
) -> DataFrame:
    """Per group, the row ranked ``n`` - or the last one when the group is smaller.

    The n-row cap runs first (with its pre-shuffle partial limit), then one
    ``max_by`` over at most n rows per group picks the last.
    """
    capped = first_n_per_group(df, group, order, n, rank_col=RANK_COL)
    picked = capped.groupBy(*group).agg(
        F.max_by(F.struct(*[F.col(f) for f in fields]), F.col(RANK_COL)).alias("_last")
    )
    return picked.select(*group, *[F.col(f"_last.{f}").alias(f) for f in fields if f not in group])

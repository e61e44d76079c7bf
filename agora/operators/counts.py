"""Counting operators: accepted records per group, direct replies per comment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_per_group(df: DataFrame, group: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per group (partial counts combine map-side before the shuffle)."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias(name))


def reply_counts(
    tree: DataFrame,
    node_col: str = "comment_id",
    parent_col: str = "parent_id",
    scope: Sequence[str] = ("post_id",),
) -> DataFrame:
    """Direct replies per comment of a flat tree; 0 is stored as missing.

    Counts are grouped by (scope, parent) and joined back on (scope, node):
    both sides hash on the same full key, so a post with a third of all
    comments still spreads over its comment ids, not onto one task.
    """
    keys = list(scope)
    counts = (
        tree.where(F.col(parent_col).isNotNull())
        .groupBy(*keys, F.col(parent_col).alias(node_col))
        .agg(F.count(F.lit(1)).alias("_replies"))
    )
    joined = tree.select(*keys, node_col).join(counts, [*keys, node_col], "left")
    return joined.select(*keys, node_col, F.nullif(F.col("_replies"), F.lit(0)).alias("replies"))

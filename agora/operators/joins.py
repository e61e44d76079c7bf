"""Join strategies for the lookups hidden in the reference's loops.

A lookup side (post ids of the stored posts, post and community flags) grows with
the data, so no join here carries a broadcast hint, counts its sides or keeps them.
In batch the plain join is left to AQE, which broadcasts a side by its measured
size and splits skewed partitions.  Streaming micro-batches do not run AQE, so for
them a hot key is spread by salting: the big side gets a deterministic salt
``hash(row) mod k`` and the lookup side is replicated k times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT_COL = "_salt"


def salted_join(
    big: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str,
    buckets: int,
) -> DataFrame:
    """Equi-join that spreads every key of ``big`` over ``buckets`` tasks.

    The salt is a hash of the whole ``big`` row, so a recomputed task gives the
    same salt (no random numbers in a shuffle key).  Supported for inner,
    left outer, left semi and left anti joins, where each ``big`` row meets
    exactly one replica of the lookup side.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salted join does not support {how!r}")
    salted_big = big.withColumn(SALT_COL, F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(buckets)))
    replicated = lookup.withColumn(SALT_COL, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    joined = salted_big.join(replicated, [*on, SALT_COL], how)
    return joined.drop(SALT_COL)


def lookup_join(
    big: DataFrame, lookup: DataFrame, on: Sequence[str] | str, how: str = "left", salt_buckets: int = 1
) -> DataFrame:
    """Join ``big`` to a lookup side: salted when ``salt_buckets > 1`` (streams), else
    a plain join left to AQE (batch)."""
    keys = [on] if isinstance(on, str) else list(on)
    if salt_buckets > 1:
        return salted_join(big, lookup, keys, how, salt_buckets)
    return big.join(lookup, keys, how)

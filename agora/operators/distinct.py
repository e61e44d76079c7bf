"""Distinct rows with bounded memory in a task.

A hash aggregate keeps a task's distinct rows in memory, and AQE makes tasks of a fixed
number of compressed bytes, which are millions of short rows.  Rows are dealt by hash over
pieces whose number grows with the input, before anything is kept of them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

PIECE_BYTES = 4 << 20  # of Catalyst's estimate, which follows compressed file sizes: about half a million pairs of ids


def distinct_rows(df: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Distinct rows of ``df``.

    Equal rows are all shuffled: reducing them first would keep a whole split's rows.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > 1 << 60:  # no estimate (an RDD-backed frame): left to the session
        return df.distinct()
    return df.repartition(max(1, math.ceil(size / piece_bytes)), *df.columns).distinct()

"""Asking the whole corpus about hashes: blocks of documents, buckets of hashes.

A block is a set of documents dealt by a hash of doc_id.  It sends each distinct
value it holds once to the bucket whose range the value falls in (one row and one
packed blob for each pair of block and bucket); the bucket answers every block with
one byte for each value, in the order sent.  A value that a third of all documents
hold costs one entry a block, and nothing is collected anywhere.

Blocks and buckets hold about BLOCK_BYTES of stored input each; their numbers grow
with the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import pieces_for

BLOCK_BYTES = 4 << 20
ASKED = "bucket long, block long, blob binary"
ANSWERED = "block long, bucket long, blob binary"


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(block, doc_id, text), and the number of blocks (and buckets)."""
    d = docs.select("doc_id", "text")
    n = pieces_for(d, block_bytes)
    return d.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).alias("block"), "doc_id", "text"), n


def ordered(t: pa.Table) -> pa.Table:
    """A block's rows in one order, whatever order they arrived in: null ids first."""
    t = t.combine_chunks()
    return t.take(pa.compute.sort_indices(t, [("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start"))


def bucket_of(key: np.ndarray, n: int) -> np.ndarray:
    """Bucket of a 64-bit key: ranges of equal width, so that it rises with the key."""
    return ((key >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def cuts(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of each run of a sorted bucket column."""
    if not len(bucket):
        return []
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    return list(zip(bucket[at].tolist(), at.tolist(), [*at[1:].tolist(), len(bucket)]))


def asked(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array([r[0] for r in rows], pa.int64()),
            "block": pa.array([r[1] for r in rows], pa.int64()),
            "blob": pa.array([r[2] for r in rows], pa.binary()),
        }
    )


def answered(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return asked([(b, a, x) for a, b, x in rows]).select(["block", "bucket", "blob"])


def in_order(answers: pa.Table) -> list[bytes]:
    """A block's answers by bucket."""
    got = sorted(zip(answers["bucket"].to_pylist(), answers["blob"].to_pylist()), key=lambda r: r[0])
    return [blob for _, blob in got]


def held_elsewhere(t: pa.Table) -> pa.Table:
    """A bucket's answer to sorted distinct uint64 values: in how many blocks each one
    is, up to 255.  The rows of the answer go back to the blocks."""
    block, blob = t["block"].to_pylist(), t["blob"].to_pylist()
    vals = [np.frombuffer(x, np.uint64) for x in blob]
    at = np.cumsum([0, *map(len, vals)])
    _, back, n = np.unique(np.concatenate(vals), return_inverse=True, return_counts=True)
    n = np.minimum(n, 255).astype(np.uint8)[back]
    bucket = t["bucket"][0].as_py()
    return answered([(block[i], bucket, n[at[i] : at[i + 1]].tobytes()) for i in range(len(vals))])

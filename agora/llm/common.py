"""Helpers shared by the training-data operators.

Words are maximal runs of bytes other than space and TAB..CR.  All of those are
ASCII, so a text can be cut on its UTF-8 bytes; ``word_spans`` and ``hash_words``
do that for a whole slice of documents at once with numpy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20  # text a Python task turns into arrays at once (or one longer document)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (from file sizes; no job runs)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def pieces_for(df: DataFrame, target_bytes: int) -> int:
    """How many pieces of about ``target_bytes`` the input makes, never fewer than
    the shuffle partitions of the session; grows with the input."""
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = plan_bytes(df)
    if size > 1 << 60:  # no estimate (an RDD-backed frame): the session's setting
        return least
    return max(least, math.ceil(size / target_bytes))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage is
    cut and a lost executor costs no recomputation."""
    path = f"{scratch_dir(df.sparkSession, purpose)}/t"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FEW_IDS = 1 << 20


def few(ids: DataFrame, limit: int = FEW_IDS) -> DataFrame:
    """``ids`` (a stored frame of one narrow column), to be broadcast if it has ``limit``
    rows at most (counted: some tens of MB), else as it is, for a shuffled join."""
    return F.broadcast(ids) if ids.limit(limit + 1).count() <= limit else ids


def crc_mod(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(n)


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and its offsets (n + 1); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes, one row at least."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; no other byte changes."""
    return _LOWER[data]


def word_spans(
    data: np.ndarray, off: np.ndarray, apart: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (byte positions) and document index of every word, in order; ``apart``
    says of each byte whether it separates words."""
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, e
    inside = ~apart[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = off[1:] > off[:-1]
    at = off[:-1][full]
    first[at] = inside[at]
    at = off[1:][full] - 1
    last[at] = inside[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix finaliser)."""
    x = np.array(x, dtype=np.uint64)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_TABLES: dict[str, np.ndarray] = {}  # filled in each Python worker on first use


def _byte_at() -> np.ndarray:
    """Random values by place in the word (up to 255) and byte."""
    if "byte_at" not in _TABLES:
        _TABLES["byte_at"] = mix64(np.arange(1 << 16, dtype=np.uint64))
    return _TABLES["byte_at"]


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: mixed sum of a random value for each (place, byte)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    at = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum()), dtype=np.int64)
    key = ((place - np.repeat(at, lens)) << 8) | data[place + np.repeat(starts - at, lens)]
    val = _byte_at()[key] if int(lens.max()) <= 256 else mix64(key)
    return mix64(np.add.reduceat(val, at) + lens.astype(np.uint64))


BASE = 0xD6E8FEB86659FD93


def rolled_all(h: np.ndarray, lengths: tuple[int, ...], base: int = BASE) -> list[np.ndarray]:
    """For each length, the hash (before mixing) of every run of so many neighbours,
    by doubling; entry i covers h[i : i + length]."""
    out: dict[int, tuple[np.ndarray, int]] = {}
    part, width = h, 1
    while width <= max(lengths):
        for n in lengths:
            if n & width:
                out[n] = (part, width) if n not in out else (_join(*out[n], part, width, base), out[n][1] + width)
        if 2 * width <= max(lengths):
            part = _join(part, width, part, width, base)
        width *= 2
    return [out[n][0][: max(0, len(h) - n + 1)] for n in lengths]


def rolled(h: np.ndarray, length: int, base: int = BASE) -> np.ndarray:
    return rolled_all(h, (length,), base)[0]


def _join(a: np.ndarray, na: int, b: np.ndarray, nb: int, base: int) -> np.ndarray:
    """Hashes of na + nb neighbours from those of na and of nb."""
    n = min(len(a), len(b) - na)
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = a[:n] * np.uint64(pow(base, nb, 1 << 64))
    out += b[na : na + n]
    return out


def sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """For each i, the place of the smallest of h[i : i + width], leftmost on ties."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    val, at, have = h, np.arange(len(h), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        a, b = val[:-step], val[step:]
        right = b < a
        val, at = np.where(right, b, a), np.where(right, at[step:], at[:-step])
        have += step
    return at[:n]


def sha256_hex(data: bytes) -> str:
    import hashlib

    return hashlib.sha256(data).hexdigest()


BLOCK = 32


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range of any length, by blocks of BLOCK bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    n_blocks = np.maximum(-(-lens // BLOCK), 1)
    at = np.cumsum(n_blocks) - n_blocks
    nth = np.arange(int(n_blocks.sum()), dtype=np.int64) - np.repeat(at, n_blocks)
    b0 = np.repeat(starts, n_blocks) + nth * BLOCK
    b1 = np.minimum(b0 + BLOCK, np.repeat(ends, n_blocks))
    h = hash_words(data, b0, b1) if (b1 > b0).all() else _hash_some(data, b0, b1)
    h = mix64(h ^ mix64(nth.astype(np.uint64)))
    return mix64(np.add.reduceat(h, at) + lens.astype(np.uint64))


def _hash_some(data: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> np.ndarray:
    out = np.zeros(len(b0), np.uint64)
    full = b1 > b0
    out[full] = hash_words(data, b0[full], b1[full])
    return out

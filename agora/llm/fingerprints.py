"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph (a piece between newlines) hashes to a wide vector with two sections,
and a text's fingerprint is the sum of its paragraphs' vectors:

* EXACT lanes modulo 2**32, from a cryptographic hash of the paragraph: equal for
  equal multisets of paragraphs, in any order, and for others only by collision;
* LIKE lanes modulo 2**16: signed counts of the paragraph's three-word shingles
  (single words in shorter paragraphs), each hashed to one lane.  The cosine of
  two such sections estimates how alike two texts are.

Sums make it incremental: ``plus`` and ``minus`` insert or delete paragraphs.

``with_next`` pairs each document with the next one in descending doc_id order.
Documents are dealt to id ranges; the one text that a range needs from its
neighbour is sent there as well, so no task sees more than its range.

Null text: empty (one empty paragraph).  A null doc_id orders as the smallest;
rows with one doc_id order by text.  One row alone is its own next document.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import hash_words, mix64, pieces_for, rolled, slices, as_bytes, word_spans

EXACT = 16
LIKE = 256
SHINGLE = 3
RANGE_BYTES = 8 << 20  # stored bytes of documents in one id range
SMALLEST = -(1 << 63)


def exact_section(text: bytes) -> np.ndarray:
    """Sum of the paragraphs' EXACT lanes."""
    raw = b"".join(hashlib.blake2b(p, digest_size=4 * EXACT).digest() for p in text.split(b"\n"))
    return np.frombuffer(raw, "<u4").reshape(-1, EXACT).sum(0, dtype=np.uint32)


def like_sections(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The LIKE lanes (int16) of each text of a slice."""
    n_docs = len(off) - 1
    starts, ends, doc = word_spans(data, off)
    h = hash_words(data, starts, ends)
    # a paragraph number that differs between paragraphs and between texts
    para = np.searchsorted(np.flatnonzero(data == 10), starts) + doc
    size = np.bincount(para, minlength=1)[para] if len(para) else para
    one = size < SHINGLE
    runs = rolled(h, SHINGLE)
    same = para[: len(runs)] == para[SHINGLE - 1 :] if len(runs) else np.zeros(0, bool)
    key = np.concatenate([mix64(runs[same]), mix64(h[one])])
    of = np.concatenate([doc[: len(runs)][same], doc[one]])
    lane = of * LIKE + (key % np.uint64(LIKE)).astype(np.int64)
    sign = ((key >> np.uint64(63)).astype(np.float64) * 2) - 1
    return np.bincount(lane, weights=sign, minlength=n_docs * LIKE).astype(np.int64).astype(np.int16).reshape(n_docs, LIKE)


def pack(exact: np.ndarray, like: np.ndarray) -> str:
    return base64.b64encode(exact.astype("<u4").tobytes() + like.astype("<i2").tobytes()).decode()


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw[: 4 * EXACT], "<u4"), np.frombuffer(raw[4 * EXACT :], "<i2")


def fingerprint(text: str | None) -> str:
    raw = (text or "").encode()
    data, off = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    return pack(exact_section(raw), like_sections(data, off)[0])


def plus(a: str, b: str) -> str:
    """Fingerprint of the paragraphs of both."""
    (ea, la), (eb, lb) = unpack(a), unpack(b)
    return pack(ea + eb, la + lb)


def minus(a: str, b: str) -> str:
    """Fingerprint of a's paragraphs without b's."""
    (ea, la), (eb, lb) = unpack(a), unpack(b)
    return pack(ea - eb, la - lb)


def likeness(exact_a: np.ndarray, like_a: np.ndarray, exact_b: np.ndarray, like_b: np.ndarray) -> float:
    """0 to 1 from two fingerprints alone; 1 if they are equal."""
    if np.array_equal(exact_a, exact_b):
        return 1.0
    a, b = like_a.astype(float), like_b.astype(float)
    norm = float(np.sqrt((a @ a) * (b @ b)))
    return min(1.0, max(0.0, float(a @ b) / norm)) if norm else 0.0


def with_next(docs: DataFrame) -> DataFrame:
    """(dest, own, doc_id, text) dealt to id ranges and sorted: own rows by id, before
    them the row (own false) whose text the range's smallest row is paired with."""
    d = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(SMALLEST)).alias("k"))
    n = pieces_for(d, RANGE_BYTES)
    cuts = sorted(set(d.approxQuantile("k", [i / n for i in range(1, n)], 0.2 / n))) if n > 1 else []
    bounds = F.lit([int(c) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    d = d.withColumn("b", F.size(F.filter(bounds, lambda c: c <= F.col("k"))))
    last = sorted((r["b"], r["k"]) for r in d.groupBy("b").agg(F.max("k").alias("k")).collect())  # a row for each range
    to = {last[i][1]: last[(i + 1) % len(last)][0] for i in range(len(last))}
    dest = F.array(F.struct(F.col("b").alias("dest"), F.lit(True).alias("own")))
    if to:
        more = F.create_map(*[F.lit(x) for pair in to.items() for x in pair])[F.col("k")]
        dest = F.when(
            F.col("k").isin(list(to)), F.concat(dest, F.array(F.struct(more.alias("dest"), F.lit(False).alias("own"))))
        ).otherwise(dest)
    d = d.select(F.explode(dest).alias("x"), "doc_id", "text", "k").select("x.dest", "x.own", "doc_id", "text", "k")
    return d.repartition(n, "dest").sortWithinPartitions("dest", "own", "k", "text").drop("k")


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited_text(text: str, following: str) -> str:
    """The last third replaced by as many code points of the following text's start."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before: tuple[object, str, np.ndarray, np.ndarray] | None = None  # of the row before, in its range
    for batch in batches:
        _, off = as_bytes(batch.column("text"))
        for i, j in slices(off):
            part = batch.slice(i, j - i)
            dest, own = part.column("dest").to_pylist(), part.column("own").to_pylist()
            ids, texts = part.column("doc_id").to_pylist(), [t or "" for t in part.column("text").to_pylist()]
            follow = [before[1] if before and before[0] == dest[0] else ""] + texts[:-1]
            edited = [edited_text(t, f) for t, f in zip(texts, follow)]
            raw, raw_edited = [t.encode() for t in texts], [t.encode() for t in edited]
            exact = [exact_section(t) for t in raw + raw_edited]
            like = np.concatenate([_likes(raw), _likes(raw_edited)])
            out: dict[str, list] = {c.split()[0]: [] for c in SCHEMA.split(", ")}
            n = len(texts)
            for k in range(n):
                last = (exact[k - 1], like[k - 1]) if k else (before[2:] if before else (None, None))
                if own[k]:
                    out["doc_id"].append(ids[k])
                    out["n_chars"].append(len(texts[k]))
                    out["edited_sha256"].append(hashlib.sha256(raw_edited[k]).hexdigest())
                    out["fingerprint"].append(pack(exact[k], like[k]))
                    out["edited_fingerprint"].append(pack(exact[n + k], like[n + k]))
                    out["near_edited"].append(likeness(exact[k], like[k], exact[n + k], like[n + k]))
                    out["near_next"].append(likeness(exact[k], like[k], *last))
            before = (dest[-1], texts[-1], exact[n - 1], like[n - 1])
            if out["doc_id"]:
                yield pa.RecordBatch.from_pydict(
                    out,
                    pa.schema(
                        [(c, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[t])
                         for c, t in (x.split() for x in SCHEMA.split(", "))]
                    ),
                )


def _likes(texts: list[bytes]) -> np.ndarray:
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return like_sections(np.frombuffer(b"".join(texts), np.uint8), off)


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and the likenesses."""
    return with_next(docs).mapInArrow(_report, SCHEMA)

"""Periodic runs of words in every document, by internal pattern matching.

A run is a maximal stretch of words with smallest period q and a length of at least
max(MIN_LENGTH, POWERS * q).  In a task, the documents of a slice are one sequence of
word numbers (numbers of one document only, so that no match leaves it):

1. prefix doubling sorts the suffixes; after round k the suffixes that share their
   first 2^k words fill one range of the suffix array;
2. blocks of 2^k words stand at every 2^(k-1) words.  A run of period q with
   2^(k-1) < q <= 2^k and four periods holds such a block together with its shift by q;
3. a wavelet matrix over the suffix array answers, for all blocks at once, the range
   successor: the next place in the block's range after the block.  Inside a run the
   block's occurrences form a progression whose step is the period, so a next place at
   most 2^k words away is a candidate period;
4. neighbouring blocks of one progression are one candidate, which grows to its full
   length by comparing the ranks of ever shorter blocks in both directions.

A candidate's step is the smallest period, as the block before it has no nearer
occurrence.  Blocks of 2^k words are made only of documents that can hold four periods
over 2^(k-1).  Everything is exact: word numbers come from the words themselves.

The job is one map over the documents, no shuffle; a task holds one slice of about
SLICE bytes of text, or one longer document.

Null or empty text has no words, so no run; a null doc_id stays null and its words are
left as they are; rows with equal ids are separate documents; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import as_bytes, slices

MIN_LENGTH = 6
POWERS = 4
SLICE = 1 << 19

SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, strongest struct<start:long,length:long,period:long>, collapsed string"


class RangeSuccessor:
    """Wavelet matrix over the numbers 0 .. n-1 in some order."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, len(values).bit_length())  # for values + 1, too
        self.zeros: list[np.ndarray] = []  # zero bits before each place, by level
        v = values.astype(np.int32)
        for b in range(self.bits - 1, -1, -1):
            one = (v >> b & 1).astype(bool)
            count = np.zeros(len(v) + 1, np.int32)
            np.cumsum(~one, out=count[1:])
            self.zeros.append(count)
            v = np.concatenate([v[~one], v[one]])

    def smaller(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of each range lo:hi are under x."""
        total = np.zeros(len(x), np.int32)
        for b, zeros in zip(range(self.bits - 1, -1, -1), self.zeros):
            one = x >> b & 1
            l0, h0 = zeros[lo], zeros[hi]
            total += one * (h0 - l0)
            lo = np.where(one, zeros[-1] + lo - l0, l0)
            hi = np.where(one, zeros[-1] + hi - h0, h0)
        return total

    def nth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value of each range (k under its length)."""
        out = np.zeros(len(k), np.int32)
        for zeros in self.zeros:
            l0, h0 = zeros[lo], zeros[hi]
            one = k >= h0 - l0
            out = out << 1 | one
            k = np.where(one, k - (h0 - l0), k)
            lo = np.where(one, zeros[-1] + lo - l0, l0)
            hi = np.where(one, zeros[-1] + hi - h0, h0)
        return out

    def after(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value of each range that is over x; -1 where there is none."""
        k = self.smaller(lo, hi, x + 1)
        some = np.flatnonzero(k < hi - lo)
        out = np.full(len(x), -1, np.int32)
        out[some] = self.nth(lo[some], hi[some], k[some])
        return out


def first_of(key: np.ndarray) -> np.ndarray:
    """True where a sorted array changes."""
    return np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)


class Blocks:
    """Suffix array of documents' words, with the rank of every dyadic block.

    ``word``: word numbers, distinct between documents; ``n``: words of each document.
    """

    def __init__(self, word: np.ndarray, n: np.ndarray):
        total = len(word)
        self.edge = np.concatenate([[0], np.cumsum(n)])
        self.doc = np.repeat(np.arange(len(n)), n)
        # the largest block that a document needs
        self.depth = np.array([max(0, int(x // POWERS - 1).bit_length()) if x >= MIN_LENGTH else -1 for x in n.tolist()])
        deep = self.depth[self.doc]
        sa = np.argsort(word, kind="stable")
        new = first_of(word[sa])
        self.ranks: list[np.ndarray] = []  # by round: first place of a suffix's range
        self.size: list[np.ndarray] = []  # by round: length of the range that starts at a place
        rank = np.empty(total, np.int64)
        size = np.zeros(total + 1, np.int64)
        at = np.flatnonzero(new)
        rank[sa] = np.repeat(at, np.diff(np.append(at, total)))
        size[at] = np.diff(np.append(at, total))
        self.ranks.append(rank.astype(np.int32))
        self.size.append(size.astype(np.int32))
        width = 1
        for k in range(1, int(self.depth.max(initial=0)) + 1):
            open_ = np.flatnonzero((size[rank[sa]] > 1) & (deep[sa] >= k))  # places in the array
            if not len(open_):
                break
            i = sa[open_]
            j = i + width
            inside = j < self.edge[self.doc[i] + 1]
            follow = np.where(inside, rank[np.minimum(j, total - 1)] + 1, 0)
            key = rank[i] * (total + 1) + follow
            order = np.argsort(key, kind="stable")
            i, key = i[order], key[order]
            sa[open_] = i
            new = first_of(key)
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(i)))
            rank, size = rank.copy(), size.copy()
            size[rank[i]] = 0
            rank[i] = np.repeat(open_[at], count)
            size[open_[at]] = count
            self.ranks.append(rank.astype(np.int32))
            self.size.append(size.astype(np.int32))
            width *= 2
        self.sa = sa

    def candidates(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, step, block length) of the leftmost block of each progression."""
        places, los, his, widths = [], [], [], []
        for k, (rank, size) in enumerate(zip(self.ranks, self.size)):
            width, stride = 1 << k, max(1, (1 << k) >> 1)
            i = np.flatnonzero((size[rank] > 1) & (self.depth[self.doc] >= k))
            i = i[(i - self.edge[self.doc[i]]) % stride == 0]
            places.append(i)
            los.append(rank[i])
            his.append(rank[i] + size[rank[i]])
            widths.append(np.full(len(i), width))
        i, lo, hi, width = (np.concatenate(x) for x in (places, los, his, widths))
        if not len(i):
            return i, i, i
        step = RangeSuccessor(self.sa).after(lo, hi, i) - i
        near = (step > 0) & (step <= width)
        i, step, width = i[near], step[near], width[near]
        order = np.lexsort((i, step, width))
        i, step, width = i[order], step[order], width[order]
        lead = first_of(step) | first_of(width)
        lead[1:] |= i[1:] - i[:-1] > width[1:]
        return i[lead], step[lead], width[lead]

    def grown(self, a: np.ndarray, b: np.ndarray, direction: int) -> np.ndarray:
        """How many words after (1) or before (-1) the places a < b are equal in turn."""
        first, end = self.edge[self.doc[a]], self.edge[self.doc[a] + 1]
        depth = self.depth[self.doc[a]]
        grown = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            width, rank = 1 << k, self.ranks[k]
            go = np.flatnonzero(depth >= k)
            while len(go):
                shift = grown[go] if direction > 0 else -grown[go] - width
                x, y = a[go] + shift, b[go] + shift
                ok = (x >= first[go]) & (y + width <= end[go])
                go, x, y = go[ok], x[ok], y[ok]
                go = go[rank[x] == rank[y]]
                grown[go] += width
        return grown

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, start in it, length, period) by document, start and period."""
        i, step, _ = self.candidates()
        back, on = self.grown(i, i + step, -1), self.grown(i, i + step, 1)
        start, length = i - back, back + on + step
        ok = length >= np.maximum(MIN_LENGTH, POWERS * step)
        start, length, step = start[ok], length[ok], step[ok]
        order = np.lexsort((step, start))
        start, length, step = start[order], length[order], step[order]
        one = first_of(start) | first_of(step)
        start, length, step = start[one], length[one], step[one]
        doc = self.doc[start]
        return doc, start - self.edge[doc], length, step


def rewritten(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The query's planted periods: in a tenth of the documents, the words from a place
    on repeat the first of them."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * times)[: n - a]


def found(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, by start and period."""
    number: list[int] = []
    for words in texts:
        own: dict[bytes, int] = {}
        base = len(number)
        number.extend([base + own.setdefault(w, len(own)) for w in words])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if number:
        blocks = Blocks(np.array(number, np.int64), np.array([len(w) for w in texts], np.int64))
        for d, *run in zip(*(x.tolist() for x in blocks.runs())):
            out[d].append(tuple(run))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by a space: of each run its first period."""
    kept, at = [], 0
    for first, end in sorted((s + p, s + n) for s, n, p in runs):
        if first > at:
            kept += words[at:first]
        at = max(at, end)
    return b" ".join(kept + words[at:])


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length by period (exactly), the first of such."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _find(planted: bool):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_dict = lambda r: dict(zip(("start", "length", "period"), r)) if r else None
        for batch in batches:
            data, off = as_bytes(batch.column("text"))
            for i, j in slices(off, SLICE):
                ids = batch.column("doc_id").slice(i, j - i)
                raw, at = data[off[i] : off[j]].tobytes(), (off[i : j + 1] - off[i]).tolist()
                texts = [raw[x:y].split() for x, y in zip(at[:-1], at[1:])]  # bytes: space and TAB..CR
                if planted:
                    texts = [rewritten(w, d) for w, d in zip(texts, ids.to_pylist())]
                runs = found(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.cast(pa.int64()),
                        pa.array([[as_dict(r) for r in rs] for rs in runs], pa.list_(kind)),
                        pa.array([as_dict(strongest(rs)) for rs in runs], kind),
                        pa.array([collapsed(w, rs).decode("utf-8", "surrogatepass") for w, rs in zip(texts, runs)], pa.string()),
                    ],
                    ["doc_id", "runs", "strongest", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """(doc_id, runs, strongest, collapsed): the runs by start and period, the one of the
    most periods (null: none), and the text without the repeats.  ``planted``: search
    the texts as ``rewritten``."""
    return docs.select("doc_id", "text").mapInArrow(_find(planted), SCHEMA)


def report(docs: DataFrame) -> DataFrame:
    """Digest of the runs of all documents with planted periods."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("strongest")
    return periodic_runs(docs, planted=True).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

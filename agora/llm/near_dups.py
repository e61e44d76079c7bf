"""MinHash near-dedup with bottom-k sketches from one hash function.

1. Sketch.  A document's set is its distinct 5-word shingles; the sketch keeps the K
   smallest shingle hashes.  Documents with equal sets form a class, and only its
   smallest id goes on.
2. Inverted lists.  A list's key is two retained values.  Sets of up to SMALL shingles
   (and those that can match one) list every pair of their smallest values that a
   match must share: no match of theirs is missed.  Larger sets list the neighbouring
   pairs of their KEYED smallest values; a match at the threshold shares a
   neighbouring pair but with probability under 3e-8.  A pair of values stays rare
   where a single one is in a line that many documents share.
3. Estimate.  Documents of a list are paired with its smallest id; the union sketch
   estimates their similarity, and pairs more than MARGIN under the threshold go.
4. Verify.  The pairs left are compared on their full shingle sets, and links are
   contracted to components.
5. Dense groups.  A list whose documents are still in several components is dealt in
   chunks of CHUNK documents; in a chunk the most typical documents (whose values are
   the most common there: the text that near copies were made of) are compared with all
   others.  What is verified is contracted, and a second round takes only a few
   documents of each component of a list, so that chunks meet.
6. The rest.  In lists of up to CHUNK documents that still hold several components, all
   are compared by sketches.  Documents of longer lists (a line or passage that many
   share) get finer ones: of a sketch's values, ordered by how few of these documents
   hold them, as many as leave fewer than a match must share (prefix filter).  The line's
   own values come last, so these lists are short; where one is not, every document
   outside its largest component meets all of the others', in chunks.  Pairs that whole
   sketches do not decide are verified on full sets, chunk by chunk: a chunk's pairs are
   packed by document, its sets are fetched once each, and it gives a forest of links.  So
   no link between different texts is lost, no pair is made only because of a common line,
   and no step makes a row for each pair of a group.

Null or empty text and texts without words have no set and are linked with nothing.
Texts under five words have one shingle.  Rows with one doc_id count as one document
with all their sets' rows reported.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import as_bytes, few, hash_words, lower, mix64, rolled, slices, stored, word_spans

SHINGLE = 5
PERCENT = 75
K = 128
KEYED = 32
SMALL = 32
MARGIN = 0.17  # over four standard deviations of a K-value estimate at the threshold
CHUNK = 1024
LIGHT = 32  # documents of a chunk that share a value and are paired one by one
MOST_VALUES = 4 << 20  # of full sets that a task compares at once
TYPICAL = 16  # documents of a chunk that all others are compared with
FEW = 8  # documents of a component that stand for it in a list's second round


def shingle_sets(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice."""
    data = lower(data)
    starts, ends, doc = word_spans(data, off)
    h = hash_words(data, starts, ends)
    n_docs = len(off) - 1
    n_words = np.bincount(doc, minlength=n_docs)
    run = mix64(rolled(h, SHINGLE))
    same = doc[: len(run)] == doc[SHINGLE - 1 :][: len(run)]
    of, val = doc[: len(run)][same], run[same]
    edge = np.concatenate([[0], np.cumsum(n_words)])
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    whole = np.array([mix64(rolled(h[edge[d] : edge[d + 1]], int(n_words[d])) + np.uint64(n_words[d]))[0] for d in short], np.uint64)
    of, val = np.concatenate([of, short]), np.concatenate([val, whole])
    order = np.lexsort((val, of))
    of, val = of[order], val[order]
    new = np.ones(len(val), bool)
    new[1:] = (val[1:] != val[:-1]) | (of[1:] != of[:-1])
    of, val = of[new], val[new]
    cut = np.searchsorted(of, np.arange(n_docs + 1))
    return [val[cut[d] : cut[d + 1]] for d in range(n_docs)]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = as_bytes(batch.column("text"))
        for i, j in slices(off):
            sets = shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(i, j - i),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([s[:K].tobytes() for s in sets], pa.binary()),
                ],
                ["doc_id", "n_shingles", "class", "sketch"],
            )


def keys(sketch: np.ndarray, n: int) -> np.ndarray:
    """The list keys of a set of n shingles (sketch: its K smallest, sorted)."""
    out = []
    if n <= SMALL * 100 // PERCENT + 1:
        # two matching sets share two of their first n - ceil(0.75 n) + 2 values
        first = sketch[: n - -(-n * PERCENT // 100) + 2]
        a, b = np.triu_indices(len(first), 1)
        out.append((first[a], first[b]))
    if n > SMALL:
        first = sketch[:KEYED]
        out.append((first[:-1], first[1:]))
    a, b = (np.concatenate(x) for x in zip(*out))
    return np.unique(mix64(a) ^ mix64(b + np.uint64(1)))


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, n, sketch = (batch.column(c).to_pylist() for c in ("doc_id", "n_shingles", "sketch"))
        for i in range(0, len(ids), 2000):
            ks = [keys(np.frombuffer(s, np.uint64), m) for s, m in zip(sketch[i : i + 2000], n[i : i + 2000])]
            of = np.repeat(np.array(ids[i : i + 2000], np.int64), [len(k) for k in ks])
            flat = np.concatenate(ks) if ks else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), pa.array(of)], ["key", "doc_id"])


def _estimate(a: np.ndarray, na: int, b: np.ndarray, nb: int) -> float:
    """Jaccard estimate of two sets from their sketches (exact if both are whole)."""
    both = np.intersect1d(a, b, assume_unique=True)
    if na <= K and nb <= K:
        return len(both) / max(1, na + nb - len(both))
    union = np.union1d(a, b)[:K]
    return len(both[both <= union[-1]]) / len(union) if len(union) else 0.0


def _pass(na: int, nb: int, est: float) -> bool:
    return 100 * est >= PERCENT - 1e-9 if na <= K and nb <= K else est >= PERCENT / 100 - MARGIN


def _sized(na: int, nb: int) -> bool:
    return 100 * min(na, nb) >= PERCENT * max(na, nb)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, na, nb, sa, sb = (batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "sa", "sb"))
        keep = [
            _sized(na[i], nb[i])
            and _pass(na[i], nb[i], _estimate(np.frombuffer(sa[i], np.uint64), na[i], np.frombuffer(sb[i], np.uint64), nb[i]))
            for i in range(len(a))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def likely_pairs(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those whose union sketch does not rule a link out."""
    left = reps.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    right = reps.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(_likely, "a long, b long")


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = as_bytes(batch.column("text"))
        for i, j in slices(off):
            sets = shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "whole"]
            )


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("wa"), batch.column("wb")):
            a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _needed(frame: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``frame`` whose doc_id is in the stored ``ids``, before they are shuffled."""
    return frame.join(few(ids.select("doc_id").distinct()), "doc_id", "left_semi")


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are linked, on full sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("whole").alias("wa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("whole").alias("wb"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(_confirm, "a long, b long")


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(doc_id, root): smallest id reachable, for every id that an edge names.

    Large-star and small-star steps in turn: neighbours of an id are linked to the
    smallest of them until every id hangs on its root; each step keeps one row a
    link at most, and a hot id's neighbours are reduced by min before they shuffle.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), purpose)
    turn = 0
    while not _all_stars(edges):
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(low.filter("m < u").select("u", F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = stored(small.filter("u <> v").distinct(), f"{purpose}-{turn}")
        turn += 1
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("doc_id"), F.col("v").alias("root")))


def _all_stars(edges: DataFrame) -> bool:
    """Whether every u of the distinct edges (u, v) has one v, and no v is a u."""
    ends = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.lit(None).cast("long").alias("v")))))
    at = ends.groupBy("u").agg(F.count("v").alias("up"), F.count(F.lit(1)).alias("n"))
    return not at.agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("up") < F.col("n")))).alias("open")).first()["open"]


def _shared(sk: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many retained values each of ``left`` shares with each other one of ``right``."""
    of = np.repeat(np.arange(len(sk)), [len(x) for x in sk])
    _, val, n = np.unique(np.concatenate(sk), return_inverse=True, return_counts=True)
    out = np.zeros((len(left), len(right)), np.float32)
    row, col = np.full(len(sk), -1), np.full(len(sk), -1)
    row[left], col[right] = np.arange(len(left)), np.arange(len(right))
    order = np.argsort(val, kind="stable")
    of, val = of[order], val[order]
    # a value of a few documents: each pair of them is counted by itself
    few = n[val] <= LIGHT
    doc, v = of[few], val[few]
    for d in range(1, LIGHT):
        same = v[d:] == v[:-d]
        if not same.any():
            break
        a, b = doc[:-d][same], doc[d:][same]
        for x, y in ((row[a], col[b]), (row[b], col[a])):
            at = (x >= 0) & (y >= 0)
            np.add.at(out, (x[at], y[at]), 1)
    # one of many: a column of a matrix
    place = np.cumsum(n > LIGHT) - 1
    of, val = of[~few], place[val[~few]]
    for k in range(0, int(val[-1]) + 1 if len(val) else 0, 1024):
        i, j = np.searchsorted(val, [k, k + 1024])
        has = np.zeros((len(sk), 1024), np.float32)
        has[of[i:j], val[i:j] - k] = 1
        out += has[left] @ has[right].T
    return out


def _columns(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    ids, root, n = (np.array(t[c].to_pylist(), np.int64) for c in ("doc_id", "root", "n_shingles"))
    return ids, root, n, [np.frombuffer(x, np.uint64) for x in t["sketch"].to_pylist()]


def _typical(key: tuple, t: pa.Table) -> pa.Table:
    """Likely pairs of a chunk's most typical documents with the others, as a forest."""
    ids, root, n, sk = _columns(t.combine_chunks().sort_by("doc_id"))
    _, val, count = np.unique(np.concatenate(sk), return_inverse=True, return_counts=True)
    size = np.array([len(x) for x in sk])
    edge = np.cumsum(size) - size
    typical = np.add.reduceat(count[val], edge) / size
    up = {r: r for r in root.tolist()}
    top = lambda r: _top(up, r)
    kept = np.minimum(n, K)
    left = np.ones(len(ids), bool)  # not yet compared and not linked
    a, b = [], []
    for _ in range(TYPICAL):
        if not left.any() or len({top(r) for r in root.tolist()}) < 2:
            break
        m = int(np.flatnonzero(left)[np.argmax(typical[left])])
        left[m] = False
        has = np.zeros(len(count), np.int64)
        has[val[edge[m] : edge[m] + size[m]]] = 1
        both = np.add.reduceat(has[val], edge)
        most = both / np.minimum(K, np.maximum(kept[m] + kept - both, 1))
        can = (most >= PERCENT / 100 - MARGIN) & (100 * np.minimum(n, n[m]) >= PERCENT * np.maximum(n, n[m]))
        for k in np.flatnonzero(can).tolist():
            x, y = top(int(root[m])), top(int(root[k]))
            if x != y and _pass(n[m], n[k], _estimate(sk[m], n[m], sk[k], n[k])):
                up[max(x, y)] = min(x, y)
                a.append(min(ids[m], ids[k]))
                b.append(max(ids[m], ids[k]))
                left[k] = False
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _estimates(sk: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``_estimate`` of the pairs (x, y) of which one set at least is larger than K."""
    _, rank = np.unique(np.concatenate(sk), return_inverse=True)
    size = np.array([len(s) for s in sk])
    held = np.arange(K) < size[:, None]
    grid = np.full((len(sk), K), 1 << 30, np.int32)
    grid[held] = rank
    out = np.empty(len(x))
    for i in range(0, len(x), 4096):
        # a value of both stands twice; an empty place comes last and equals no other's
        z = np.sort(np.concatenate([grid[x[i : i + 4096]], grid[y[i : i + 4096]]], 1), 1)
        twice = (z[:, 1:] == z[:, :-1]) & (z[:, 1:] < 1 << 30)
        nth = np.arange(2, 2 * K + 1) - np.cumsum(twice, 1)
        out[i : i + 4096] = (twice & (nth <= K)).sum(1) / K
    return out


def _top(up: dict[int, int], r: int) -> int:
    while up[r] != r:
        up[r] = r = up[up[r]]
    return r


def _forest(up: dict[int, int], of_a: np.ndarray, of_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of the links (a, b), of components ``of_a`` and ``of_b``, those that join two trees
    of ``up``, which takes them in."""
    out = []
    for x, y, i, j in zip(of_a.tolist(), of_b.tolist(), a.tolist(), b.tolist()):
        x, y = _top(up, x), _top(up, y)
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((min(i, j), max(i, j)))
    return out


MET = "key long, p long, q long, doc_id long, linked binary, open binary"


def _compare(key: tuple, t: pa.Table) -> pa.Table:
    """Pairs of two chunks of a list that sketches do not rule out, between different
    components, a row a document: the ids that whole sketches link it with (a forest of
    the chunks), and those left to full sets, whose rows may hold no ids themselves.
    Only the list of a pair's smallest shared key looks at it."""
    ids, root, n, sk = _columns(t := t.combine_chunks().sort_by("doc_id"))
    side = np.array(t["side"].to_pylist(), np.int64)
    this, p, q = (x.as_py() for x in key)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if p == q:  # the pairs of the chunk that are not within its largest component
        of, size = np.unique(root, return_counts=True)
        left, right = np.flatnonzero(root != of[np.argmax(size)]), np.arange(len(ids))
    if not len(left) or not len(right):
        return _by_document(key, ids, [], np.zeros(0, np.int64), np.zeros(0, np.int64))
    both = _shared(sk, left, right)
    kept = np.minimum(n, K)
    # an upper bound of the estimate, so that no pair is lost here
    most = both / np.minimum(K, np.maximum(kept[left][:, None] + kept[right] - both, 1))
    can = (root[left][:, None] != root[right]) & (most >= PERCENT / 100 - MARGIN)
    can &= 100 * np.minimum(n[left][:, None], n[right]) >= PERCENT * np.maximum(n[left][:, None], n[right])
    if p == q:
        can &= (left[:, None] < right) | ~np.isin(right, left)
    if can.any():
        smaller = [k[k < this] for k in (np.array(k, np.int64) for k in t["keys"].to_pylist())]
        can &= _shared(smaller, left, right) == 0
    x, y = np.nonzero(can)
    both = both[x, y].astype(float)
    x, y = left[x], right[y]
    est = both / np.maximum(1, n[x] + n[y] - both)  # exact where both sketches are whole
    whole = (n[x] <= K) & (n[y] <= K)
    if not whole.all():
        est[~whole] = _estimates(sk, x[~whole], y[~whole])
    good = np.where(whole, 100 * est >= PERCENT - 1e-9, est >= PERCENT / 100 - MARGIN)
    sure = _forest({r: r for r in root.tolist()}, root[x[good & whole]], root[y[good & whole]], ids[x[good & whole]], ids[y[good & whole]])
    return _by_document(key, ids, sure, x[good & ~whole], y[good & ~whole])


def _by_document(key: tuple, ids: np.ndarray, sure: list[tuple[int, int]], x: np.ndarray, y: np.ndarray) -> pa.Table:
    """Rows of MET: the links ``sure`` and the open pairs (places x and y in ``ids``)."""
    linked: dict[int, list[int]] = {}
    for a, b in sure:
        linked.setdefault(a, []).append(b)
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    cut = np.searchsorted(x, np.arange(len(ids) + 1))
    named = np.zeros(len(ids), bool)
    named[x], named[y] = True, True
    rows = [k for k, i in enumerate(ids.tolist()) if named[k] or i in linked]
    fixed = {c: pa.array([v.as_py()] * len(rows), pa.int64()) for c, v in zip(("key", "p", "q"), key)}
    return pa.table(fixed | {
        "doc_id": pa.array(ids[rows], pa.int64()),
        "linked": pa.array([np.array(linked.get(int(ids[k]), []), np.int64).tobytes() for k in rows], pa.binary()),
        "open": pa.array([ids[y[cut[k] : cut[k + 1]]].tobytes() if named[k] else None for k in rows], pa.binary()),
    })


def _runs(size: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of neighbours that hold about ``most`` values, one at least."""
    edge, i = np.concatenate([[0], np.cumsum(size)]), 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(edge, edge[i] + most, side="right")) - 1)
        yield slice(i, j)
        i = j


def _confirm_chunk(key: tuple, t: pa.Table) -> pa.Table:
    """A forest of the links among a chunk's open pairs, on full sets; a document with
    several sets is linked by any of them."""
    t = t.to_pydict()
    held = sorted(set(zip(t["doc_id"], t["whole"])))
    of, sets = np.array([i for i, _ in held], np.int64), [np.frombuffer(x, np.uint64) for _, x in held]
    met: dict[int, np.ndarray] = {}
    for i, o in zip(t["doc_id"], t["open"]):
        met[i] = np.union1d(met.get(i, np.zeros(0, np.int64)), np.frombuffer(o, np.int64))
    size = np.array([len(x) for x in sets])
    left, up, out = np.flatnonzero([len(met[i]) > 0 for i in of.tolist()]), {i: i for i in met}, []
    for i in _runs(size[left], MOST_VALUES // 2):
        a = left[i]
        right = np.flatnonzero(np.isin(of, np.concatenate([met[k] for k in of[a].tolist()])))
        for j in _runs(size[right], MOST_VALUES // 2):
            b = right[j]
            asked = np.array([np.isin(of[b], met[k]) for k in of[a].tolist()])
            used = np.union1d(a, b)
            both = _shared([sets[k] for k in used.tolist()], np.searchsorted(used, a), np.searchsorted(used, b)).astype(np.int64)
            x, y = np.nonzero(asked & (100 * both >= PERCENT * (size[a][:, None] + size[b] - both)))
            x, y = of[a[x]], of[b[y]]
            out += _forest(up, x, y, x, y)
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def open_lists(lists: DataFrame, root: DataFrame) -> DataFrame:
    """(key, doc_id, root) of the lists that hold several components; of lists with the
    same members, which give the same pairs, one."""
    member = lists.join(root, "doc_id", "left").select("key", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    state = member.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"),
        F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.sum(F.xxhash64("doc_id", F.lit(1)).cast("decimal(38,0)")).alias("s"),
    )
    one = state.filter("lo < hi").groupBy("n", "x", "s").agg(F.min("key").alias("key"))
    return member.join(one.select("key", "n"), "key")


def _first_of_components(open_: DataFrame) -> DataFrame:
    """At most FEW documents of each component of a list, with the list's new size."""
    w = Window.partitionBy("key", "root").orderBy(F.xxhash64("doc_id"), "doc_id")
    few_ = open_.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= FEW).select("key", "doc_id", "root")
    fewer = few_.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # lists without a component of some size stay as they were: the first round saw them
    grown = open_.groupBy("key").agg(F.count(F.lit(1)).alias("was")).join(fewer, "key").filter("2 * n <= was")
    return few_.join(grown.select("key", "n"), "key")


def dense_pairs(open_: DataFrame, reps: DataFrame, turn: int) -> DataFrame:
    """Likely pairs between components by typical documents of the stored ``open_`` lists;
    a heuristic that only has to find the bulk, as ``rest_links`` finds all others."""
    sketches = _needed(reps.select("doc_id", "n_shingles", "sketch"), open_)
    if turn:
        open_ = _first_of_components(open_)
    chunk = F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.ceil(F.col("n") / F.lit(CHUNK)).cast("long"))
    dealt = open_.select("key", chunk.alias("p"), "doc_id", "root").join(sketches, "doc_id")
    return dealt.groupBy("key", "p").applyInArrow(_typical, "a long, b long").distinct()


def shared_least(n: Column) -> Column:
    """How many retained values a match of a set of n shingles shares with it at least."""
    kept = F.least(n, F.lit(K))
    # two whole sets: 75 % of the larger; else what the estimate asks of a union sketch
    return F.least(F.ceil(kept * F.lit(PERCENT) / 100), F.lit(int(K * (PERCENT / 100 - MARGIN)))).cast("int")


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 2000):
            part = batch.slice(i, 2000)
            sk = [np.frombuffer(x, np.int64) for x in part.column("sketch").to_pylist()]
            at = np.repeat(np.arange(len(sk)), [len(x) for x in sk])
            flat = pa.array(np.concatenate(sk) if sk else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(at)), part.column("n_shingles").take(pa.array(at)), flat], ["doc_id", "n_shingles", "key"])


def finer_keys(long: DataFrame, reps: DataFrame) -> DataFrame:
    """(doc_id, keys) of the documents ``long`` (doc_id): keys of lists by their rarest
    values, so many that two documents that match have one in common."""
    held = reps.join(few(long), "doc_id", "left_semi").mapInArrow(_values, "doc_id long, n_shingles long, key long")
    held = stored(held, "near-values")
    count = held.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # a value that no other document holds is the rarest, and lists nobody: only its number counts
    shared = held.join(count, "key")
    w = Window.partitionBy("doc_id").orderBy(F.desc("n"), "key")  # at most K values a document
    nth = shared.withColumn("nth", F.row_number().over(w))
    # the values that come last in this order, all but (least - 1), are the prefix
    return nth.filter(F.col("nth") >= shared_least(F.col("n_shingles"))).groupBy("doc_id").agg(F.collect_list("key").alias("keys"))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, sketch = (batch.column(c).to_pylist() for c in ("n_shingles", "sketch"))
        ks = [keys(np.frombuffer(s, np.uint64), m).view(np.int64) for s, m in zip(sketch, n)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ks, pa.list_(pa.int64()))], [*batch.schema.names, "keys"])


def _unpacked_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = [np.frombuffer(x, np.int64) for x in batch.column("linked").to_pylist()]
        at = np.repeat(np.arange(len(linked)), [len(x) for x in linked])
        flat = np.concatenate(linked) if linked else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at)), pa.array(flat)], ["a", "b"])


def rest_links(open_: DataFrame, root: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """The links between components within the stored ``open_`` lists: of each two chunks
    that meet, a forest."""
    long = stored(open_.filter(F.col("n") > CHUNK).select("doc_id").distinct(), "near-long")
    kind = "doc_id long, n_shingles long, sketch binary, keys array<bigint>"
    keyed = _needed(reps.filter("n_shingles > 1"), open_).mapInArrow(_keys, kind)
    met = _met(open_.filter(F.col("n") <= CHUNK), keyed)
    if not long.isEmpty():
        finer = stored(finer_keys(long, reps), "near-finer")
        listed = finer.select(F.explode("keys").alias("key"), "doc_id")
        met = met.unionByName(_met(stored(open_lists(listed, root), "near-open"), _needed(reps, finer).join(finer, "doc_id")))
    met = stored(met, "near-met")
    pairs = met.filter("open IS NOT NULL").select("key", "p", "q", "doc_id", "open")
    open_links = pairs.join(_needed(sets, pairs), "doc_id").groupBy("key", "p", "q").applyInArrow(_confirm_chunk, "a long, b long")
    sure = met.filter("octet_length(linked) > 0").select("doc_id", "linked").mapInArrow(_unpacked_links, "a long, b long")
    return open_links.unionByName(sure)


def _met(open_: DataFrame, keyed: DataFrame) -> DataFrame:
    """Rows of MET of the stored lists ``open_``; ``keyed``: sketches of their documents,
    with the keys of all lists that a document may be in."""
    sizes = open_.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("key").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.sum("size").alias("n"), F.max("size").alias("most"))
    dealt = open_.select("key", "doc_id", "root").join(largest, "key")
    chunks = lambda n: F.ceil(n / F.lit(CHUNK)).cast("long")
    upto = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))
    zero, h = F.lit(0).cast("long"), F.xxhash64("doc_id", F.lit(2))
    # a component with most of a long list is not compared with itself
    split = (F.col("n") > CHUNK) & (2 * F.col("most") > F.col("n"))
    n_main = F.when(split, chunks(F.col("most"))).otherwise(zero)
    n_left = chunks(F.when(split, F.col("n") - F.col("most")).otherwise(F.col("n")))
    in_main = split & (F.col("root") == F.col("main"))
    own = F.when(in_main, n_left + F.pmod(h, F.greatest(n_main, F.lit(1)))).otherwise(F.pmod(h, n_left))
    dealt = dealt.select("key", "doc_id", "root", own.alias("c"), in_main.alias("in_main"), n_left.alias("n_left"), (n_left + n_main).alias("n_all"))
    dealt = stored(dealt, "near-dealt")  # read twice
    # a chunk outside it meets itself, every later one and the largest component's chunks
    c, one = F.col("c"), F.lit(1).cast("long")
    left = dealt.filter(~F.col("in_main")).select(
        "key", c.alias("p"), F.explode(upto(c, F.col("n_all") - one)).alias("q"), "doc_id", "root", F.lit(0).alias("side")
    )
    right = dealt.select("key", F.explode(upto(zero, F.least(c, F.col("n_left")) - one)).alias("p"), c.alias("q"), "doc_id", "root", F.lit(1).alias("side"))
    met = left.unionByName(right).join(keyed.select("doc_id", "n_shingles", "sketch", "keys"), "doc_id")
    return met.groupBy("key", "p", "q").applyInArrow(_compare, MET)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    d = docs.select("doc_id", "text")
    sketched = stored(d.mapInArrow(_sketch, "doc_id long, n_shingles long, class binary, sketch binary"), "near-sketch")
    rows = sketched.select("doc_id", "n_shingles", "class")
    classes = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "near-classes")
    reps = sketched.join(classes.select("class", F.col("rep").alias("doc_id")), ["class", "doc_id"]).dropDuplicates(["doc_id", "class"])
    reps = stored(reps.select("doc_id", "n_shingles", "sketch"), "near-reps")
    posted = reps.filter("n_shingles > 1").mapInArrow(_list, "key long, doc_id long")
    lists = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low")).filter("n > 1")
    lists = stored(posted.join(lists, "key").select("key", "doc_id", "low"), "near-lists")
    listed = few(stored(lists.select("doc_id").distinct(), "near-listed"))
    reps = stored(reps.join(listed, "doc_id", "left_semi"), "near-sketches")  # no other sketch is looked at again
    first = lists.filter("doc_id <> low").select(F.col("low").alias("a"), F.col("doc_id").alias("b")).distinct()
    first = stored(likely_pairs(first, reps), "near-stars")
    sets = stored(d.join(listed, "doc_id", "left_semi").mapInArrow(_whole, "doc_id long, whole binary").filter("octet_length(whole) > 0"), "near-sets")
    # a document with rows of several sets links their classes
    full = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    several = full.groupBy("doc_id").agg(F.min("class").alias("x"), F.max("class").alias("y")).filter("x <> y").select("doc_id")
    own = full.join(several, "doc_id", "left_semi").join(classes, "class").select("doc_id", "rep")
    same = own.join(own.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").filter("a <> rep").select("a", F.col("rep").alias("b"))
    linked = stored(links(first, sets).unionByName(same), "near-links")
    root = stored(components(linked, "near-roots"), "near-root")
    open_, grown = lists.select("key", "doc_id"), True
    for turn in (0, 1, 2):
        if grown:  # a list of one component stays one
            open_ = stored(open_lists(open_.select("key", "doc_id"), root), "near-open")
        if turn < 2:
            likely = stored(dense_pairs(open_, reps, turn), "near-likely")
            ids = likely.select(F.explode(F.array("a", "b")).alias("doc_id"))
            more = None if likely.isEmpty() else links(likely, _needed(sets, ids))
        else:
            more = rest_links(open_, root, reps, sets)
        more = more and stored(more, f"near-more-{turn}")
        grown = more is not None and not more.isEmpty()
        if not grown:  # the components stay as they are
            continue
        # components found so far enter the next contraction as stars, which it keeps
        stars = root.select(F.col("doc_id").alias("a"), F.col("root").alias("b"))
        root = stored(components(stars.unionByName(more), "near-roots"), "near-root")
    # a class has its representative's root, a document that of its class
    rooted = classes.join(root.withColumnRenamed("doc_id", "rep"), "rep", "left").select("class", F.coalesce("root", "rep").alias("root"))
    by_doc = full.join(rooted, "class").groupBy("doc_id").agg(F.min("root").alias("root"))
    out = rows.join(by_doc, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document stays: one document of each component."""
    gone = stored(near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct(), "near-gone")
    return docs.join(few(gone), "doc_id", "left_anti")

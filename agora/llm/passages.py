"""Substring dedup by prefix-partitioned suffix trees.

A suffix is a word position; only its first WINDOW words matter.  The suffixes are
split by variable-length prefixes into groups of bounded size, each group's suffix
tree is built from the sorted suffixes and their common prefixes, and internal nodes
WINDOW words deep are the repeats.

1. Pruning.  Every window has an anchor, the ANCHOR-word run with the smallest hash
   in it.  Equal windows have equal anchors, so only windows whose anchor occurs twice
   in the corpus can repeat.  Blocks ask buckets how many blocks hold each anchor.
2. Trees.  The suffixes left go to groups: by their first PREFIX words, or by the
   whole window where their anchor is in HEAVY or more blocks (a prefix that many
   documents share).  A block sends each distinct suffix once.  A node is a repeat if
   two blocks, or two places of one block, hang below it.
3. Removal.  Each block covers its repeated windows and hashes what is left.

A suffix travels as 64 hash bits of its path (the edge of PREFIX words, the edge down
to WINDOW words).  Its group is chosen by other bits of the hash, so what tells two
windows apart grows with the number of groups, and that with the input.

Null text: no words.  Texts under WINDOW words lose nothing.  Rows with one doc_id
are separate texts.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from agora.llm import blocks as bl
from agora.llm.common import as_bytes, hash_words, mix64, rolled_all, sliding_argmin, slices, word_spans

WINDOW = 35
ANCHOR = 19
PREFIX = 12
HEAVY = 64
LAST_BITS = 40  # of 64 in a path, for the edge below the prefix

SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class Suffixes:
    """The words of a slice of texts and its windows (all of one text)."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.starts, self.ends, self.doc = word_spans(data, off)
        self.n = len(self.starts)
        h = hash_words(data, self.starts, self.ends)
        prefix, anchor, window = rolled_all(h, (PREFIX, ANCHOR, WINDOW))
        anchor = mix64(anchor)
        fits = np.flatnonzero(self.doc[: len(window)] == self.doc[WINDOW - 1 :][: len(window)])
        place = sliding_argmin(anchor, WINDOW - ANCHOR + 1)
        self.at = fits  # where windows start
        self.anchor = anchor[place[fits]]
        self.prefix, self.window = mix64(prefix[fits]), mix64(window[fits])


def _slices(t: pa.Table) -> Iterator[tuple[Suffixes, pa.Table, np.ndarray, np.ndarray]]:
    data, off = as_bytes(t["text"])
    for i, j in slices(off):
        o = off[i : j + 1] - off[i]
        d = data[off[i] : off[j]]
        yield Suffixes(d, o), t.slice(i, j - i), d, o


def _distinct_anchors(found: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _ask_anchors(n_buckets: int):
    def ask(key: tuple, t: pa.Table) -> pa.Table:
        block = key[0].as_py()
        uniq = _distinct_anchors([np.unique(s.anchor) for s, *_ in _slices(t)])
        return bl.asked([(b, block, uniq[i:j].tobytes()) for b, i, j in bl.cuts(bl.bucket_of(uniq, n_buckets))])

    return ask


def path(prefix: np.ndarray, window: np.ndarray) -> np.ndarray:
    """A suffix as its path from the root: bits of the PREFIX-word edge, then of the rest."""
    low = np.uint64((1 << LAST_BITS) - 1)
    return (prefix << np.uint64(LAST_BITS)) | (window & low)


class Candidates:
    """A block's windows that can repeat, and its distinct suffixes in group order."""

    def __init__(self, t: pa.Table, held: np.ndarray, n_buckets: int):
        parts = list(_slices(t))
        every = [s.anchor for s, *_ in parts]
        uniq, count = np.unique(np.concatenate(every), return_counts=True) if every else (np.zeros(0, np.uint64), np.zeros(0, int))
        repeated = (held > 1) | (count > 1)
        self.parts = parts
        self.where, pre, win, heavy = [], [], [], []
        for s, *_ in parts:
            k = np.searchsorted(uniq, s.anchor)
            can = repeated[k] if len(k) else np.zeros(0, bool)
            self.where.append(s.at[can])
            pre.append(s.prefix[can])
            win.append(s.window[can])
            heavy.append(held[k[can]] >= HEAVY if len(k) else can)
        pre, win = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (pre, win))
        group = np.where(np.concatenate(heavy) if heavy else np.zeros(0, bool), mix64(win), pre)
        bucket, code = bl.bucket_of(group, n_buckets), path(pre, win)
        order = np.lexsort((code, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (code[order][1:] != code[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        self.of = np.empty(len(order), np.int64)  # of each window: which distinct suffix
        self.of[order] = np.cumsum(new) - 1
        first = order[new]
        self.bucket, self.code = bucket[first], code[first]
        self.twice = np.bincount(self.of, minlength=len(first)) > 1  # twice in this block


def _held(answers: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(bl.in_order(answers)), np.uint8)


def _ask_suffixes(n_buckets: int):
    def ask(key: tuple, t: pa.Table, answers: pa.Table) -> pa.Table:
        if not t.num_rows:
            return bl.asked([])
        block = key[0].as_py()
        held = _held(answers)
        c = Candidates(bl.ordered(t), held, n_buckets)
        rows = [(b, block, c.code[i:j].tobytes()) for b, i, j in bl.cuts(c.bucket)]
        # what the block was told stays with it: a group of its own hands it back
        return bl.asked([*rows, (-1 - block, block, held.tobytes())])

    return ask


def subtree(code: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The suffix tree of a group: the sorted order of its suffixes, and the internal
    nodes (first, end, depth in words) of the order, from common prefixes."""
    order = np.argsort(code, kind="stable")
    sorted_ = code[order]
    nodes: list[tuple[int, int, int]] = []
    for edge, depth in ((sorted_ >> np.uint64(LAST_BITS), PREFIX), (sorted_, WINDOW)):
        same = np.concatenate([[False], edge[1:] == edge[:-1], [False]])
        rise = np.flatnonzero(same[1:] & ~same[:-1])
        fall = np.flatnonzero(~same[1:] & same[:-1]) + 1
        nodes += [(a, b, depth) for a, b in zip(rise.tolist(), fall.tolist())]
    return order, nodes


def _grow(key: tuple, t: pa.Table) -> pa.Table:
    bucket = key[0].as_py()
    block, blob = t["block"].to_pylist(), t["blob"].to_pylist()
    if bucket < 0:
        return bl.answered([(block[0], -1, blob[0])])
    sets = [np.frombuffer(x, np.uint64) for x in blob]
    at = np.cumsum([0, *map(len, sets)])
    order, nodes = subtree(np.concatenate(sets))
    repeat = np.zeros(len(order), np.uint8)
    for a, b, depth in nodes:
        if depth >= WINDOW:
            repeat[order[a:b]] = 1
    return bl.answered([(block[i], bucket, repeat[at[i] : at[i + 1]].tobytes()) for i in range(len(sets))])


def _remove(n_buckets: int):
    def remove(key: tuple, t: pa.Table, answers: pa.Table) -> pa.Table:
        return _left(t, answers, n_buckets)

    return remove


def _left(t: pa.Table, answers: pa.Table, n_buckets: int) -> pa.Table:
    out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": []}
    if t.num_rows:
        held, *told = bl.in_order(answers)
        c = Candidates(bl.ordered(t), np.frombuffer(held, np.uint8), n_buckets)
        repeat = (np.frombuffer(b"".join(told), np.uint8) > 0) | c.twice
        at = 0
        for (s, part, data, off), where in zip(c.parts, c.where):
            hit = np.zeros(s.n + WINDOW, np.int64)
            hit[where[repeat[c.of[at : at + len(where)]]]] = 1
            at += len(where)
            total = np.concatenate([np.zeros(WINDOW, np.int64), np.cumsum(hit)])
            kept = total[WINDOW : WINDOW + s.n] == total[: s.n]  # no hit in the WINDOW starts up to here
            edge = np.searchsorted(s.doc, np.arange(len(off)))
            raw = data.tobytes()
            for k, doc_id in enumerate(part["doc_id"].to_pylist()):
                keep = kept[edge[k] : edge[k + 1]]
                words = raw[off[k] : off[k + 1]].split()
                out["doc_id"].append(doc_id)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - int(keep.sum()))
                out["kept_sha256"].append(hashlib.sha256(b" ".join(compress(words, keep.tolist()))).hexdigest())
    return pa.table(out, pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]))


def removed(docs: DataFrame, block_bytes: int = bl.BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    d, n = bl.blocks(docs, block_bytes)
    by_block = d.groupBy("block")
    anchors = by_block.applyInArrow(_ask_anchors(n), bl.ASKED).groupBy("bucket").applyInArrow(bl.held_elsewhere, bl.ANSWERED)
    suffixes = by_block.cogroup(anchors.groupBy("block")).applyInArrow(_ask_suffixes(n), bl.ASKED)
    told = suffixes.groupBy("bucket").applyInArrow(_grow, bl.ANSWERED)
    return by_block.cogroup(told.groupBy("block")).applyInArrow(_remove(n), SCHEMA)

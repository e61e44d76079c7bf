"""Exact substring dedup over bytes by prefix-free parsing.

Removes every byte covered by a WINDOW-byte string that also starts earlier (smaller
doc_id, or earlier in the same text).

1. Parsing.  A place is a trigger when the rolling hash of its TRIGGER bytes is the
   smallest of some window, so every window has one and equal windows have it at the
   same offset.  A trigger's phrase runs from the first window it decides to the end
   of the last one; phrases depend on their own bytes only.  Blocks ask in how many
   blocks each trigger occurs: phrases of single triggers cannot repeat.
2. Dictionary.  A block sends each distinct phrase left once, with its first place
   (the parse).  The bucket of a trigger holds its dictionary; sorting the phrases'
   windows by 64 bits of hash (beside those that chose the bucket) puts equal ones side
   by side, and the parse's places order them by corpus position.  All but the first of
   each are told to the blocks.  No suffix array is built: only equality of whole
   windows is asked for.
   A trigger in HEAVY or more blocks (a line that many documents share, each with other
   neighbours) could fill one bucket with its phrases; their windows go to buckets by
   their own hash instead, one code each.
3. Removal.  Each block covers those windows, and all windows of phrases it holds a
   second time, and hashes the bytes left.

Highly repetitive text costs one phrase a block, whatever the number of copies.

Null text: empty.  Texts under WINDOW bytes lose nothing.  A null doc_id orders as
the smallest; rows with one doc_id order by text.  Other columns are ignored.
"""

from __future__ import annotations

import ctypes
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from agora.llm import blocks as bl
from agora.llm.common import as_bytes, mix64, rolled_all, sliding_argmin, slices

WINDOW = 100
TRIGGER = 40
HEAVY = 64
BLOCK_BYTES = 2 << 20  # bytes are many more units than words
PIECE = 1 << 19  # windows that a bucket sorts at once
SLICE = 1 << 18
SMALLEST = -(1 << 63)
SECOND_BASE = 0x9E6C63D0876A9A47

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _trim() -> None:
    """Hand freed memory back between groups: workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc: nothing to trim
        return


def _byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64))


def parse(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """The phrases of a slice of texts, in order: trigger hash, first window, number of
    windows, and two 64-bit hashes of the phrase's bytes."""
    trigger, window = rolled_all(_byte_values()[data], (TRIGGER, WINDOW))
    n = len(window)
    if not n:
        e = np.zeros(0, np.uint64)
        return e, e.astype(np.int64), e.astype(np.int64), e, e
    trigger = mix64(trigger)
    # 32 bits order the triggers (a tie goes to the leftmost, in equal windows alike)
    place = sliding_argmin((trigger >> np.uint64(32)).astype(np.uint32), WINDOW - TRIGGER + 1)
    fits = np.zeros(n + 1, bool)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        fits[a : max(a, b - WINDOW + 1)] = True
    fits = fits[:n]
    new = fits.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~fits[:-1]
    first = np.flatnonzero(new)
    last = fits.copy()
    last[:-1] &= (place[1:] != place[:-1]) | ~fits[1:]
    end = np.flatnonzero(last)
    where = place[first].astype(np.int64)
    # first and last window and the trigger's offset fix all bytes of the phrase
    shape = mix64(((end - first).astype(np.uint64) << np.uint64(32)) | (where - first).astype(np.uint64))
    a, b = mix64(window[first]), mix64(window[end])
    # triggers are small hashes: mixed anew, they deal evenly over ranges
    return mix64(trigger[where]), first, end - first + 1, mix64(a ^ mix64(b + shape)), mix64(b ^ mix64(mix64(a) + shape))


class Parse:
    """A block's phrases (positions run through the whole block)."""

    def __init__(self, t: pa.Table):
        self.t = t
        self.data, self.off = as_bytes(t["text"])
        parts = []
        for i, j in slices(self.off, SLICE):
            hit = parse(self.data[self.off[i] : self.off[j]], self.off[i : j + 1] - self.off[i])
            parts.append((hit[0], hit[1] + self.off[i], *hit[2:]))
        none = np.zeros(0, np.uint64)
        cols = [np.concatenate(c) for c in zip(*parts)] if parts else [none, none.astype(np.int64), none.astype(np.int64), none, none]
        self.trigger, self.first, self.windows, self.h1, self.h2 = cols
        self.triggers, of, self.count = np.unique(self.trigger, return_inverse=True, return_counts=True)
        self.of_trigger = of

    def repeated(self, held: np.ndarray) -> None:
        """Keep the phrases whose trigger occurs twice; find the distinct ones, by
        trigger, and the first place of each."""
        keep = ((held > 1) | (self.count > 1))[self.of_trigger] if len(self.of_trigger) else np.zeros(0, bool)
        heavy = (held >= HEAVY)[self.of_trigger] if len(self.of_trigger) else keep
        self.trigger, self.first, self.windows, self.h1, self.h2, heavy = (
            x[keep] for x in (self.trigger, self.first, self.windows, self.h1, self.h2, heavy)
        )
        order = np.lexsort((self.first, self.h2, self.h1, self.trigger))
        new = np.ones(len(order), bool)
        for k, h in enumerate((self.trigger, self.h1, self.h2)):
            differ = h[order][1:] != h[order][:-1]
            new[1:] = differ if k == 0 else new[1:] | differ
        alone = order[new]
        self.later = order[~new]
        self.distinct, self.heavy = alone[~heavy[alone]], alone[heavy[alone]]

    def raw(self, k: np.ndarray) -> np.ndarray:
        """Bytes of the phrases k, one after the other."""
        return self.data[_ranges(self.first[k], self.windows[k] + WINDOW - 1)]

    def heavy_windows(self, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bucket, code and first place of the distinct windows of heavy phrases, sorted by
        bucket and code; places of the others."""
        parts = [self.heavy[i : i + 2000] for i in range(0, len(self.heavy), 2000)]
        both = [suffix_order(self.raw(k), self.windows[k])[:2] for k in parts]
        none = np.zeros(0, np.uint64)
        h1, h2 = (np.concatenate(c) for c in zip(*both)) if both else (none, none)
        at = _ranges(self.first[self.heavy], self.windows[self.heavy])
        bucket = bl.bucket_of(mix64(h1), n_buckets) + n_buckets
        order = np.lexsort((at, h2, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (h2[order][1:] != h2[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        k = order[new]
        return bucket[k], h2[k], at[k], at[order[~new]]

    def doc_ids(self, at: np.ndarray) -> np.ndarray:
        ids = np.array([SMALLEST if x is None else x for x in self.t["doc_id"].to_pylist()], np.int64)
        return ids[np.searchsorted(self.off, at, side="right") - 1]


def _held(answers: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(bl.in_order(answers)), np.uint8)


def _ask_triggers(n_buckets: int):
    def ask(key: tuple, t: pa.Table) -> pa.Table:
        _trim()
        block, uniq = key[0].as_py(), Parse(t).triggers
        return bl.asked([(b, block, uniq[i:j].tobytes()) for b, i, j in bl.cuts(bl.bucket_of(uniq, n_buckets))])

    return ask


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after the other."""
    at = np.cumsum(lens) - lens
    return np.arange(int(lens.sum()), dtype=np.int64) + np.repeat(starts - at, lens)


_HEAD = 8  # bytes of the counts before the arrays of a packed dictionary


def _pack(doc: np.ndarray, first: np.ndarray, windows: np.ndarray, raw: np.ndarray) -> bytes:
    body = doc.astype("<i8").tobytes() + first.astype("<i8").tobytes() + windows.astype("<u2").tobytes() + raw.tobytes()
    return len(doc).to_bytes(_HEAD, "little") + pa.compress(body, codec="zstd", asbytes=True) + len(body).to_bytes(8, "little")


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    n, size = int.from_bytes(blob[:_HEAD], "little"), int.from_bytes(blob[-8:], "little")
    body = pa.decompress(blob[_HEAD:-8], decompressed_size=size, codec="zstd", asbytes=True)
    a, b, c = 8 * n, 16 * n, 18 * n
    return (np.frombuffer(body[:a], "<i8"), np.frombuffer(body[a:b], "<i8"),
            np.frombuffer(body[b:c], "<u2").astype(np.int64), np.frombuffer(body[c:], np.uint8))


def _ask_phrases(n_buckets: int):
    def ask(key: tuple, t: pa.Table, answers: pa.Table) -> pa.Table:
        if not t.num_rows:
            return bl.asked([])
        _trim()
        block, held = key[0].as_py(), _held(answers)
        p = Parse(bl.ordered(t))
        p.repeated(held)
        d = p.distinct
        doc = p.doc_ids(p.first[d])
        rows = []
        for b, i, j in bl.cuts(bl.bucket_of(p.trigger[d], n_buckets)):
            k = d[i:j]
            rows.append((b, block, _pack(doc[i:j], p.first[k], p.windows[k], p.raw(k))))
        bucket, code, at, _ = p.heavy_windows(n_buckets)
        doc = p.doc_ids(at)
        rows += [(b, block, code[i:j].tobytes() + doc[i:j].tobytes()) for b, i, j in bl.cuts(bucket)]
        return bl.asked([*rows, (-1 - block, block, held.tobytes())])

    return ask


def suffix_order(raw: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each window of a dictionary's phrases, and its phrase."""
    if not len(windows):
        none = np.zeros(0, np.uint64)
        return none, none, none.astype(np.int64)
    vals = _byte_values()[raw]
    (h1,), (h2,) = rolled_all(vals, (WINDOW,)), rolled_all(vals, (WINDOW,), SECOND_BASE)
    lens = windows + WINDOW - 1
    at = _ranges(np.cumsum(lens) - lens, windows)
    return h1[at], h2[at], np.repeat(np.arange(len(windows)), windows)


def _earliest(n_buckets: int):
    def answer(key: tuple, t: pa.Table) -> pa.Table:
        _trim()
        bucket = key[0].as_py()
        block, blob = t["block"].to_pylist(), t["blob"].to_pylist()
        if bucket < 0:
            return bl.answered([(block[0], -1, blob[0])])
        told = _later_windows(blob) if bucket < n_buckets else _later_codes(blob)
        return bl.answered([(b, bucket, x) for b, x in zip(block, told)])

    return answer


def _later_windows(blob: list[bytes]) -> list[bytes]:
    """The bucket's dictionary: for each window of each phrase, whether the corpus has
    it earlier than at the phrase's place."""
    codes, orders, docs = [], [], []
    for x in blob:
        doc, first, windows, raw = _unpack(x)
        h1, h2, phrase = suffix_order(raw, windows)
        codes.append(mix64(h1) ^ h2)
        docs.append(doc)
        # the document's rank takes the upper half below, the place in its block the lower
        place = first[phrase] + _ranges(np.zeros(len(windows), np.int64), windows)
        orders.append((place.astype(np.uint32), phrase.astype(np.uint32)))
    rank = np.unique(np.concatenate(docs), return_inverse=True)[1].astype(np.uint64) << np.uint64(32)
    size = np.cumsum([0, *map(len, codes)])
    n_phrases = np.cumsum([0, *map(len, docs)])
    code, order = np.empty(size[-1], np.uint64), np.empty(size[-1], np.uint64)
    for i in range(len(blob)):
        place, phrase = orders[i]
        code[size[i] : size[i + 1]] = codes[i]
        order[size[i] : size[i + 1]] = rank[n_phrases[i] + phrase.astype(np.int64)] | place
        codes[i] = orders[i] = None
    later = np.zeros(len(code), bool)
    pieces = max(1, len(code) // PIECE)
    of = bl.bucket_of(code, pieces).astype(np.uint16) if pieces < 1 << 16 else bl.bucket_of(code, pieces)
    for k in range(pieces):  # a range of codes at a time
        at = np.flatnonzero(of == k)
        at = at[np.lexsort((order[at], code[at]))]
        later[at[1:]] = code[at[1:]] == code[at[:-1]]
    return [np.packbits(later[size[i] : size[i + 1]]).tobytes() for i in range(len(blob))]


def _later_codes(blob: list[bytes]) -> list[bytes]:
    """The same for windows that came one by one."""
    parts = [(np.frombuffer(x[: len(x) // 2], np.uint64), np.frombuffer(x[len(x) // 2 :], np.int64)) for x in blob]
    size = np.cumsum([0, *(len(p[0]) for p in parts)])
    code, doc = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((doc, code))
    later = np.zeros(len(order), np.uint8)
    later[order[1:]] = code[order[1:]] == code[order[:-1]]
    return [np.packbits(later[size[i] : size[i + 1]]).tobytes() for i in range(len(parts))]


def _remove(n_buckets: int):
    def remove(key: tuple, t: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {c.split()[0]: [] for c in SCHEMA.split(", ")}
        if t.num_rows:
            _trim()
            held, *told = bl.in_order(answers)
            p = Parse(bl.ordered(t))
            p.repeated(np.frombuffer(held, np.uint8))
            d = p.distinct
            cuts = bl.cuts(bl.bucket_of(p.trigger[d], n_buckets))
            bucket, _, at, again = p.heavy_windows(n_buckets)
            places = [_ranges(p.first[d[i:j]], p.windows[d[i:j]]) for _, i, j in cuts]
            places += [at[i:j] for _, i, j in bl.cuts(bucket)]
            hit = np.zeros(len(p.data) + WINDOW, np.int8)
            for where, bits in zip(places, told, strict=True):
                hit[where[np.unpackbits(np.frombuffer(bits, np.uint8), count=len(where)) > 0]] = 1
            hit[again] = 1
            hit[_ranges(p.first[p.later], p.windows[p.later])] = 1
            total = np.concatenate([np.zeros(WINDOW, np.int32), np.cumsum(hit, dtype=np.int32)])
            n = len(p.data)
            gone = total[WINDOW : WINDOW + n] > total[:n]
            for k, doc_id in enumerate(p.t["doc_id"].to_pylist()):
                a, b = p.off[k], p.off[k + 1]
                g = gone[a:b]
                out["doc_id"].append(doc_id)
                out["n_bytes"].append(int(b - a))
                out["n_removed"].append(int(g.sum()))
                out["n_spans"].append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()))
                out["kept_sha256"].append(hashlib.sha256(p.data[a:b][~g].tobytes()).hexdigest())
        kinds = {"long": pa.int64(), "string": pa.string()}
        return pa.table(out, pa.schema([(c, kinds[k]) for c, k in (x.split() for x in SCHEMA.split(", "))]))

    return remove


def removed(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    d, n = bl.blocks(docs, block_bytes)
    by_block = d.groupBy("block")
    triggers = by_block.applyInArrow(_ask_triggers(n), bl.ASKED).groupBy("bucket").applyInArrow(bl.held_elsewhere, bl.ANSWERED)
    phrases = by_block.cogroup(triggers.groupBy("block")).applyInArrow(_ask_phrases(n), bl.ASKED)
    told = phrases.groupBy("bucket").applyInArrow(_earliest(n), bl.ANSWERED)
    return by_block.cogroup(told.groupBy("block")).applyInArrow(_remove(n), SCHEMA)

"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The pieces and their scores come from a public model file (a parameter; read on the
driver, its tables travel with the job).  A text is cut where no merge can cross
(before a run of spaces, around characters without a piece), and every segment is
encoded by merges in order of score, the leftmost first: the agenda.  A candidate
merge is skipped when a hash of (seed, doc_id, copy, place of the segment in the text,
place in the segment, left piece, right piece) falls under the dropout, so a run is
repeatable, segmentations vary between seeds, documents, copies of a document and the
occurrences of a word, and a skipped candidate stays skipped.  Dropout 0 gives the
model's own segmentation.

Each round merges the best candidate of every segment of a slice of documents.  Equal
segments are first encoded once without dropout, noting every candidate met.  An
occurrence that skips none of these comes out the same; all others are encoded each by
itself.  Segments longer than LONG run through a heap instead, with the same result.

Losslessness: a space is the mark U+2581, one mark is put before the text and taken
off again; a character without a piece, and U+2581 itself, becomes its UTF-8 bytes.

Null text gives null ids and null text again; empty text gives no ids.  Other columns
pass through.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import as_bytes, mix64, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 10
SLICE = 1 << 19
LONG = 64
MARK = "▁"
NONE = np.int32(1 << 30)


@dataclass
class Tables:
    """What encoding and decoding need of a model."""

    chars: dict[int, int]  # code point: id of the one-character piece
    pair: np.ndarray  # sorted keys (left id << 16 | right id) of the merges
    merged: np.ndarray  # their pieces
    rank: np.ndarray  # by piece: order of its merge
    byte: np.ndarray  # by byte value: id of the byte piece
    text: np.ndarray  # bytes of all pieces, one after the other
    at: np.ndarray  # where a piece's bytes start


def load(model: str = MODEL) -> Tables:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    n = sp.get_piece_size()
    plain = {sp.id_to_piece(i): i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
    byte = np.zeros(256, np.int32)
    raw = []
    for i in range(n):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(piece[1:-1], 16)
            byte[value] = i
            raw.append(bytes([value]))
        else:
            raw.append(piece.replace(MARK, " ").encode() if piece in plain else b"")
    order = sorted((p for p in plain if len(p) > 1), key=lambda p: (-sp.get_score(plain[p]), plain[p]))
    rank = np.zeros(n, np.int32)
    rank[[plain[p] for p in order]] = np.arange(len(order))
    pairs = sorted(
        (plain[p[:k]] << 16 | plain[p[k:]], plain[p])
        for p in order for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain
    )
    return Tables(
        {ord(p): i for p, i in plain.items() if len(p) == 1},
        np.array([k for k, _ in pairs], np.int64), np.array([v for _, v in pairs], np.int32), rank, byte,
        np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]),
    )


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after the other."""
    at = np.cumsum(lens) - lens
    return np.arange(int(lens.sum()), dtype=np.int64) + np.repeat(starts - at, lens)


class Encoder:
    def __init__(self, tables: Tables, dropout: float = DROPOUT, seed: int = SEED):
        self.t = tables
        self.char = np.full(0x110000, -1, np.int32)
        for cp, i in tables.chars.items():
            self.char[cp] = i
        self.char[ord(" ")], self.char[ord(MARK)] = self.char[ord(MARK)], -1
        self.limit = np.uint64(int(dropout * (1 << 32)))
        self.key = mix64(np.array([seed], np.uint64))[0]
        self.rank = tables.rank[tables.merged]  # by pair
        self.place: dict[int, int] | None = None  # of a pair, for long segments
        # pairs by hash: most neighbours are no pair, and meet an empty slot at once
        bits = max(4, (8 * len(tables.pair)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        todo = np.arange(len(tables.pair), dtype=np.int32)
        slot = self._slot(tables.pair)
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]  # of several for one slot, one stays
            left = self.slots[slot] != todo
            todo, slot = todo[left], (slot[left] + 1) & ((1 << bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _pairs(self, key: np.ndarray) -> np.ndarray:
        """The number of each pair of neighbours; -1 where it is none."""
        slot = self._slot(key)
        k = self.slots[slot]
        wrong = np.flatnonzero((k >= 0) & (self.t.pair[k] != key))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & (len(self.slots) - 1)
            k[wrong] = self.slots[slot[wrong]]
            wrong = wrong[(k[wrong] >= 0) & (self.t.pair[k[wrong]] != key[wrong])]
        return k

    def _candidates(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, salt: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE: no merge, or skipped) and piece of each pair of neighbours; without
        ``salt`` none is skipped."""
        key = left.astype(np.int64) << 16 | right
        k = self._pairs(key)
        k[(left < 0) | (right < 0)] = -1
        met = np.flatnonzero(k >= 0)
        rank, piece = np.full(len(k), NONE), np.zeros(len(k), np.int32)
        if salt is not None:
            met = met[~self._skips(salt[met], key[met], place[met])]
        rank[met], piece[met] = self.rank[k[met]], self.t.merged[k[met]]
        return rank, piece

    def _skips(self, salt: np.ndarray, key: np.ndarray, place: np.ndarray) -> np.ndarray:
        own = mix64(key.astype(np.uint64) ^ (place.astype(np.uint64) << np.uint64(40)))
        return mix64(salt ^ own) >> np.uint64(32) < self.limit

    def _together(
        self, sym: np.ndarray, lens: np.ndarray, salt: np.ndarray | None, met: list | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Encode many segments; their symbols and the number of each one's pieces.
        ``met`` takes (segment, pair, place) of all candidates."""
        n = len(lens)
        seg = np.repeat(np.arange(n, dtype=np.int32), lens)
        place = ranges(np.zeros(n, np.int64), lens).astype(np.int32)
        done_sym, done_seg = [], []

        def score(sel: np.ndarray, a: np.ndarray, s: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            nxt = np.minimum(sel + 1, len(a) - 1)
            rank, piece = self._candidates(a[sel], a[nxt], p[sel], None if salt is None else salt[s[sel]])
            rank = np.where((nxt > sel) & (s[nxt] == s[sel]), rank, NONE)
            if met is not None:
                ok = rank < NONE
                met.append((s[sel[ok]], a[sel[ok]].astype(np.int64) << 16 | a[nxt[ok]], p[sel[ok]]))
            return rank, piece

        rank, piece = score(np.arange(len(sym)), sym, seg, place)
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            size = np.diff(np.append(first, len(sym)))
            low = np.minimum.reduceat(rank, first)
            go = low < NONE
            if not go.all():
                stop = ~np.repeat(go, size)
                done_sym.append(sym[stop])
                done_seg.append(seg[stop])
                sym, seg, place, rank, piece = (x[~stop] for x in (sym, seg, place, rank, piece))
                if not len(sym):
                    break
                size, low = size[go], low[go]
                first = np.cumsum(size) - size
            # the leftmost best candidate of each segment
            best = np.flatnonzero(rank == np.repeat(low, size))
            at = best[np.concatenate([[True], seg[best][1:] != seg[best][:-1]])]
            sym[at] = piece[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            new = at - np.arange(len(at))  # one symbol fewer for each segment before
            sym, seg, place, rank, piece = (x[keep] for x in (sym, seg, place, rank, piece))
            redo = np.concatenate([new, new[(new > 0)] - 1])
            rank[redo], piece[redo] = score(redo, sym, seg, place)
        sym, seg = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_sym, done_seg))
        order = np.argsort(seg, kind="stable")
        return sym[order], np.bincount(seg, minlength=n)

    def _agenda(self, sym: np.ndarray, salt: np.uint64 | None) -> np.ndarray:
        """Encode one long segment through a heap of candidates, on plain numbers."""
        n = len(sym)
        if self.place is None:
            self.place = dict(zip(self.t.pair.tolist(), range(len(self.t.pair))))
        place, ranks, pieces = self.place, self.rank, self.t.merged
        base, limit, low = None if salt is None else int(salt), int(self.limit), (1 << 64) - 1

        def mixed(x: int) -> int:  # as mix64
            x = x + 0x9E3779B97F4A7C15 & low
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & low
            x = (x ^ x >> 27) * 0x94D049BB133111EB & low
            return x ^ x >> 31

        got = sym.tolist()
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []
        alive = [True] * n

        def candidate(i: int) -> tuple[int, int, int, int, int] | None:
            j = nxt[i]
            if j >= n or got[i] < 0 or got[j] < 0:
                return None
            key = got[i] << 16 | got[j]
            k = place.get(key)
            if k is None or base is not None and mixed(base ^ mixed(key ^ i << 40)) >> 32 < limit:
                return None
            return int(ranks[k]), i, got[i], got[j], int(pieces[k])

        for i in range(n - 1):
            if c := candidate(i):
                heap.append(c)
        heapq.heapify(heap)
        while heap:
            _, i, a, b, p = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j >= n or got[i] != a or got[j] != b:
                continue
            got[i], alive[j], nxt[i] = p, False, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for at in (i, prv[i]):
                if at >= 0 and (c := candidate(at)):
                    heapq.heappush(heap, c)
        return np.array([x for x, ok in zip(got, alive) if ok], sym.dtype)

    def encode(self, texts: list[str], variant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has; texts of another
        ``variant`` (a number of 64 bits) skip other candidates."""
        texts = [" " + t if t else "" for t in texts]
        lens = np.array([len(t) for t in texts], np.int64)
        cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(cp):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        sym = self.char[cp]
        space, odd = cp == 32, sym < 0
        new = np.zeros(len(cp), bool)
        new[1:] = (space[1:] & ~space[:-1]) | odd[1:] | odd[:-1]
        edge = np.cumsum(lens) - lens
        new[edge[lens > 0]] = True
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(cp)))
        doc = np.repeat(np.arange(len(texts)), lens)[start]
        h = mix64(cp.astype(np.uint64) | (ranges(np.zeros(len(start), np.int64), size).astype(np.uint64) << np.uint64(32)))
        # distinct segments without dropout
        _, where, same = np.unique(mix64(np.add.reduceat(h, start)), return_index=True, return_inverse=True)
        s, z = start[where], size[where]
        fall = sym[s] < 0
        ids_of: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # segments, sizes, ids
        met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        short = np.flatnonzero(~fall & (z <= LONG))
        got, count = self._together(sym[ranges(s[short], z[short])], z[short], None, met if self.limit else None)
        ids_of.append((short, count, got))
        if not self.limit:
            for u in np.flatnonzero(~fall & (z > LONG)):
                got = self._agenda(sym[s[u] : s[u] + z[u]], None)
                ids_of.append((np.array([u]), np.array([len(got)]), got))
        odd_at = np.flatnonzero(fall)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in cp[s[odd_at]]]
        ids_of.append((odd_at, np.array([len(r) for r in raw], np.int64), self.t.byte[np.frombuffer(b"".join(raw), np.uint8)]))
        back = same
        if self.limit:
            # occurrences that skip a candidate become segments of their own, after the distinct ones
            salt = mix64(mix64(self.key ^ mix64(variant))[doc] ^ (start - edge[doc]).astype(np.uint64))
            seg, pair, place = (np.concatenate(x) for x in zip(*met))
            order = np.argsort(seg, kind="stable")
            pair, place = pair[order], place[order]
            n_met = np.zeros(len(s), np.int64)
            n_met[short] = np.bincount(seg, minlength=len(short))
            cand = ranges((np.cumsum(n_met) - n_met)[same], n_met[same])
            occ = np.repeat(np.arange(len(same)), n_met[same])
            own = (z > LONG)[same] & ~fall[same]
            own[occ[self._skips(salt[occ], pair[cand], place[cand])]] = True
            own = np.flatnonzero(own)
            back = same.copy()
            back[own] = len(s) + np.arange(len(own))
            few = np.flatnonzero(size[own] <= LONG)
            o = own[few]
            got, count = self._together(sym[ranges(start[o], size[o])], size[o], salt[o])
            ids_of.append((len(s) + few, count, got))
            for u in np.flatnonzero(size[own] > LONG):
                i = own[u]
                got = self._agenda(sym[start[i] : start[i] + size[i]], salt[i])
                ids_of.append((np.array([len(s) + u]), np.array([len(got)]), got))
        n_seg = max(len(s), int(back.max()) + 1)
        n_ids, at = np.zeros(n_seg, np.int64), np.zeros(n_seg, np.int64)
        total = 0
        for u, count, got in ids_of:
            n_ids[u], at[u] = count, total + np.cumsum(count) - count
            total += len(got)
        flat = np.concatenate([got for *_, got in ids_of]).astype(np.int32)
        ids = flat[ranges(at[back], n_ids[back])]
        per_doc = np.bincount(doc, weights=n_ids[back], minlength=len(texts)).astype(np.int64)
        return ids, per_doc


def decode(ids: np.ndarray, per_doc: np.ndarray, tables: Tables) -> list[bytes]:
    """The UTF-8 bytes that each run of ids stands for."""
    lens = np.diff(tables.at)[ids]
    flat = tables.text[ranges(tables.at[ids], lens)].tobytes()
    edge = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(per_doc)])]
    return [flat[a + 1 : b] if b > a else b"" for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


def _encode(tables: Tables, dropout: float, seed: int, column: str, id_column: str, copy_column: str | None, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(tables, dropout, seed)
        for batch in batches:
            _, off = as_bytes(batch.column(column))
            for i, j in slices(off, SLICE):
                part = batch.slice(i, j - i)
                texts = part.column(column).to_pylist()
                ids = np.array([x or 0 for x in part.column(id_column).to_pylist()], np.int64).view(np.uint64)
                variant = mix64(ids)
                if copy_column:
                    copy = np.array([x or 0 for x in part.column(copy_column).to_pylist()], np.int64).view(np.uint64)
                    variant = mix64(variant ^ copy)
                flat, n = enc.encode([t or "" for t in texts], variant)
                edge = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edge), pa.array(flat, pa.int32()), mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], [*keep, "ids"])

    return run


def encoded(docs: DataFrame, tables: Tables, dropout: float = DROPOUT, seed: int = SEED, copy: str | None = None) -> DataFrame:
    """``docs`` with ids array<int>; ``copy``: the column that tells a document's copies apart."""
    schema = f"{', '.join(f'`{c}` {t}' for c, t in docs.dtypes)}, ids array<int>"
    return docs.mapInArrow(_encode(tables, dropout, seed, "text", "doc_id", copy, docs.columns), schema)


def _decode(tables: Tables, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                lists = part.column("ids")
                n = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0), np.int64)
                flat = np.asarray(lists.flatten(), np.int64)
                raw = decode(flat, n, tables)
                gone = lists.is_null().to_pylist()
                text = pa.array([None if g else r.decode("utf-8", "surrogatepass") for r, g in zip(raw, gone)], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), text], [*keep, "decoded"])

    return run


def decoded(rows: DataFrame, tables: Tables) -> DataFrame:
    """``rows`` (with ids) with the decoded text."""
    schema = f"{', '.join(f'`{c}` {t}' for c, t in rows.dtypes)}, decoded string"
    return rows.mapInArrow(_decode(tables, rows.columns), schema)


def _compare(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("text"), batch.column("decoded")
            b = b.cast(a.type)
            none = pc.and_(a.is_null(), b.is_null())
            same = pc.if_else(none, True, pc.fill_null(pc.equal(a, b), False))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), batch.column("ids"), same], [*keep, "ids", "lossless"])

    return run


def round_trip(
    docs: DataFrame, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED, keep: list[str] | None = None,
    copy: str | None = None,
) -> DataFrame:
    """(doc_id, kept columns, ids, n_ids, lossless): encoded with dropout, decoded again and compared.

    The three steps of ``encoded``, ``decoded`` and the comparison follow each other in one
    Python worker: two for each task, with the texts between them, filled an executor."""
    tables, kept = load(model), ["doc_id", *(keep or [])]
    d = docs.select("doc_id", "text", *(keep or []), *([copy] if copy else []))
    encode = _encode(tables, dropout, seed, "text", "doc_id", copy, d.columns)
    decode, compare = _decode(tables, [*d.columns, "ids"]), _compare(kept)
    types = dict(d.dtypes)
    schema = f"{', '.join(f'`{c}` {types[c]}' for c in kept)}, ids array<int>, lossless boolean"
    back = d.mapInArrow(lambda batches: compare(decode(encode(batches))), schema)
    n_ids = F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids")
    return back.select(*kept, "ids", n_ids, "lossless")

"""Token counts by a compiled tokenizer: two deterministic transducers, no encoding.

The public tokenizer file (a parameter) holds byte-level merges.  Two machines are made
of it, both read a text from left to right:

* The splitter reads character classes and marks where the tokenizer's words begin.  It
  has eight states.  What its pattern looks ahead for (the end of a white-space run, the
  letters of a contraction) is part of the input symbol.  A slice of documents is cut in
  chunks of CHUNK characters; every chunk's map from entry state to exit state is made
  for all chunks at once, a parallel prefix scan composes the maps, and a second pass
  marks the words from the entry states then known.
* The counter reads the bytes of a word; each transition carries by how many tokens the
  encoding of the word so far grows (0 or less where a merge takes earlier tokens in).  A
  state holds, for every suffix that some vocabulary entry begins with, the token before
  it and how many tokens fewer stand there, so the next token is the longest suffix that
  may follow the token before it.  States are made when they are first met, by
  determinisation, and kept for the worker's life; beyond MAX_STATES the table starts
  anew at the next slice.  All words of a slice advance together, a byte at a time; long
  words are cut in chunks, whose maps (entry state: exit state, tokens) are made for the
  entry states that occur and composed in order.

Two tokens may stand side by side if no merge crosses their border in time: none joins a
symbol of the first one's right edge with one of the second's left edge before either is
taken into a larger one.

Letters, numbers and white space are those of the library: where two tables of Unicode
disagree, the library's own splitter is asked.  A special token's string in a text is
one token and ends the word before it, as the library has it by default.

The job is one map over the documents, no shuffle.  Null text is empty and has no
tokens; null ids and repeated rows are separate rows of the result; other columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import as_bytes, slices

MODEL = "byte_bpe_50k.json"
LIMIT = 512  # tokens
SLICE = 1 << 19
CHUNK = 64  # characters of a splitter's chunk
LONG = 256  # bytes of a counter's chunk; words over this are long
MAX_STATES = 1 << 18
BIAS = 1 << 15

# input symbols of the splitter
LETTER, NUMBER, OTHER, SHORT, LONGER, INNER, LAST, SPACE, SINGLE, SPECIAL, REST = range(11)
# its states: nothing open, in letters, numbers, others, white space, after a leading
# space, one and two letters of a contraction to come
_OPEN, _LETTERS, _NUMBERS, _OTHERS, _WHITE, _LEAD, _ONE, _TWO = range(8)
STATES = 8


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and word mark by (symbol, state)."""
    to, mark = np.zeros((REST + 1, STATES), np.uint8), np.ones((REST + 1, STATES), bool)
    for symbol, own in ((LETTER, _LETTERS), (NUMBER, _NUMBERS), (OTHER, _OTHERS)):
        to[symbol] = own
        mark[symbol, [own, _LEAD]] = False
    for symbol, own in ((SHORT, _ONE), (LONGER, _TWO)):  # an apostrophe that may begin a contraction
        to[symbol] = own
        to[symbol, [_OTHERS, _LEAD]] = _OTHERS
        mark[symbol, [_OTHERS, _LEAD]] = False
    to[INNER] = _WHITE  # white space with more after it
    mark[INNER, _WHITE] = False
    to[LAST] = _OPEN  # white space that ends the text
    mark[LAST, _WHITE] = False
    to[SPACE] = _LEAD  # a space before something else
    to[SINGLE] = _OPEN  # other white space before something else
    to[:, _ONE], mark[:, _ONE] = _OPEN, False
    to[:, _TWO], mark[:, _TWO] = _ONE, False
    to[SPECIAL] = to[REST] = _OPEN
    mark[SPECIAL], mark[REST] = True, False
    return to, mark


def composed(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan: row k becomes the map of rows 0 to k in turn."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], 1)
        step *= 2
    return maps


# character classes, as the splitter's pattern needs them
_KINDS = "letter number other blank apostrophe space stmd rv e l special".split()
C = {k: i for i, k in enumerate(_KINDS)}


def classes(tokenizer) -> np.ndarray:
    """The class of every code point."""
    import unicodedata

    import regex
    from tokenizers import pre_tokenizers

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    kind = {"L": C["letter"], "N": C["number"]}
    major = np.full(0x110000, C["other"], np.uint8)
    major[points] = [kind.get(unicodedata.category(c)[0], C["other"]) for c in every]
    other = np.full(0x110000, C["other"], np.uint8)
    for k, name in kind.items():
        for m in regex.finditer(rf"\p{{{k}}}+", every):
            other[points[m.start() : m.end()]] = name
    unsure = np.flatnonzero(major != other).tolist()
    # one of these joins an a before and after it if it is a letter, a 1 if it is a number
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    for i in range(0, len(unsure), 4096):
        part = unsure[i : i + 4096]
        found = split.pre_tokenize_str("".join(f"a{chr(c)}a\n1{chr(c)}1\n" for c in part))
        starts = {a for _, (a, _) in found}
        for k, c in enumerate(part):
            at = 8 * k
            major[c] = (
                C["letter"] if not {at + 1, at + 2} & starts
                else C["number"] if not {at + 5, at + 6} & starts else C["other"]
            )
    major[[ord(c) for c in regex.findall(r"\s", every)]] = C["blank"]
    for chars, k in ((" ", "space"), ("'", "apostrophe"), ("stmd", "stmd"), ("rv", "rv"), ("e", "e"), ("l", "l")):
        major[[ord(x) for x in chars]] = C[k]
    return major


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: itself where it is
    one, else the next character from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass
class Model:
    """What counting needs of a tokenizer file; its size is the vocabulary's."""

    tokens: list[bytes]  # the 256 bytes, then the merges' results by rank
    parts: list[tuple[int, int]]  # of each merge
    special: list[bytes]
    kinds: np.ndarray = field(repr=False)
    key: str = ""


def load(model: str = MODEL) -> Model:
    """Read a byte-level tokenizer file; ``model``: a public file's name, or a path."""
    import hashlib
    import json
    import os

    if not os.path.exists(model):
        import public_tokenizers

        model = public_tokenizers.path(model)
    from tokenizers import Tokenizer

    with open(model, "rb") as f:
        raw = f.read()
    spec = json.loads(raw)
    split, own = spec["pre_tokenizer"], spec["model"]
    if split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or spec["normalizer"] or own["ignore_merges"]:
        raise ValueError(f"{model}: not a plain byte-level tokenizer")
    to_byte = byte_of_char()
    number: dict[bytes, int] = {bytes([b]): b for b in range(256)}
    tokens, parts = [bytes([b]) for b in range(256)], []
    for pair in own["merges"]:
        a, b = (bytes(to_byte[c] for c in x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
        if a + b in number:
            raise ValueError(f"{model}: two merges make one token")
        parts.append((number[a], number[b]))
        number[a + b] = len(tokens)
        tokens.append(a + b)
    special = [t["content"].encode() for t in spec["added_tokens"]]
    return Model(tokens, parts, special, classes(Tokenizer.from_str(raw.decode())), hashlib.sha256(raw).hexdigest())


class Counter:
    """The byte transducer, its states made on demand."""

    def __init__(self, model: Model):
        self.parts = model.parts
        self.merge = {a << 20 | b: 256 + k for k, (a, b) in enumerate(model.parts)}
        self.child: dict[int, int] = {}  # node << 8 | byte: node
        self.token: list[int] = [-1]  # by node: the vocabulary entry that ends there
        self.inner: list[bool] = [True]  # by node: there is more below
        for t, raw in enumerate(model.tokens):
            node = 0
            for byte in raw:
                new = self.child.setdefault(node << 8 | byte, len(self.token))
                if new == len(self.token):
                    self.token.append(-1)
                    self.inner.append(False)
                    self.inner[node] = True
                node = new
            self.token[node] = t
        self.apart: dict[int, bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.clear()

    def clear(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.edges_made = 0
        self._table(1 << 16)
        self._state((-1, ()))  # a word's begin

    def _table(self, size: int) -> None:
        """Transitions by hash of (state << 8 | byte): next state << 16 | growth."""
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        self.shift = np.uint64(64 - (size.bit_length() - 1))

    def _slot(self, edge: np.ndarray) -> np.ndarray:
        """Where each transition is kept, or the empty slot where it would be."""
        slot = (edge.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        wrong = np.flatnonzero((self.keys[slot] != edge) & (self.keys[slot] >= 0))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[wrong]]
            wrong = wrong[(held != edge[wrong]) & (held >= 0)]
        return slot

    def _take(self, edge: np.ndarray) -> np.ndarray:
        """The transitions' values; missing ones are made."""
        slot = self._slot(edge)
        missing = self.keys[slot] < 0
        if missing.any():
            new = np.unique(edge[missing])
            self.edges_made += len(new)
            if 2 * self.edges_made > len(self.keys):
                keys, values = self.keys, self.values
                self._table(4 * len(keys))
                self._put(keys[keys >= 0], values[keys >= 0])
            self._put(new, np.array([self._make(e >> 8, e & 255) for e in new.tolist()], np.int64))
            slot = self._slot(edge)
        return self.values[slot]

    def _put(self, edge: np.ndarray, value: np.ndarray) -> None:
        """Keep distinct new transitions; where several want one slot, one goes in a round."""
        while len(edge):
            slot = self._slot(edge)
            self.keys[slot] = edge
            won = self.keys[slot] == edge
            self.values[slot[won]] = value[won]
            edge, value = edge[~won], value[~won]

    def _state(self, state: tuple) -> int:
        k = self.number.setdefault(state, len(self.states))
        if k == len(self.states):
            self.states.append(state)
        return k

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(symbol, the token that takes it in) along one edge of a token; the token
        itself is taken in by none."""
        got = self.edges.get((token, side))
        if got is None:
            got, above = [], 1 << 20
            while True:
                got.append((token, above))
                if token < 256:
                    break
                token, above = self.parts[token - 256][side], token
            self.edges[got[0][0], side] = got
        return got

    def _may_follow(self, a: int, b: int) -> bool:
        key = a << 20 | b
        ok = self.apart.get(key)
        if ok is None:
            ok = True
            right = self._edge(b, 0)
            for x, taken in self._edge(a, 1):
                for y, into in right:
                    m = self.merge.get(x << 20 | y)
                    # of equal merges the left one goes first
                    if m is not None and m < taken and m <= into:
                        ok = False
            self.apart[key] = ok
        return ok

    def _make(self, k: int, byte: int) -> int:
        last, open_ = self.states[k]
        found, grows, kept = -1, 0, []
        for node, before, count in (*open_, (0, last, 0)):  # the longest suffix first
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token[node]
            if found < 0 and token >= 0 and (before < 0 or self._may_follow(before, token)):
                found, grows = token, count + 1
            if self.inner[node]:
                kept.append((node, before, count))
        new = self._state((found, tuple((n, b, c - grows) for n, b, c in kept)))
        return new << 16 | grows + BIAS

    def advance(self, data: np.ndarray, at: np.ndarray, size: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run the byte ranges from their entry states: exit states and tokens grown by."""
        order = np.argsort(-size, kind="stable")
        at, size, state = at[order], size[order], state[order].astype(np.int64)
        total = np.zeros(len(at), np.int64)
        longest = int(size[0]) if len(size) else 0
        more = len(size) - np.searchsorted(size[::-1], np.arange(longest), side="right")  # ranges longer than p
        for p in range(longest):
            n = int(more[p])
            value = self._take(state[:n] << 8 | data[at[:n] + p])
            total[:n] += (value & 0xFFFF) - BIAS
            state[:n] = value >> 16
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return state[back], total[back]

    def count(self, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of each word (a byte range of ``data``)."""
        raw, number = data.tobytes(), {}  # equal words of a slice run once
        edges = zip(at.tolist(), (at + size).tolist())
        same = np.array([number.setdefault(raw[a:b], len(number)) for a, b in edges], np.int64)
        size = np.array([len(w) for w in number], np.int64)
        data, at = np.frombuffer(b"".join(number), np.uint8), np.cumsum(size) - size
        out = np.zeros(len(at), np.int64)
        short = np.flatnonzero(size <= LONG)
        out[short] = self.advance(data, at[short], size[short], np.zeros(len(short), np.int64))[1]
        for w in np.flatnonzero(size > LONG):
            out[w] = self._long(data[at[w] : at[w] + size[w]])
        return out[same]

    def _long(self, word: np.ndarray) -> int:
        """A long word by chunks: each chunk's map holds the entry states met so far.  All
        chunks are run from the exits of the chunks before them until the maps compose;
        a chunk that is not settled after some rounds is run in turn."""
        at = np.arange(0, len(word), LONG)
        size = np.minimum(LONG, len(word) - at)
        entry = np.zeros(len(at), np.int64)
        leave, grown = self.advance(word, at, size, entry)
        for _ in range(3):
            want = np.concatenate([[0], leave[:-1]])
            redo = np.flatnonzero(want != entry)
            if not len(redo):
                return int(grown.sum())
            entry[redo] = want[redo]
            leave[redo], grown[redo] = self.advance(word, at[redo], size[redo], entry[redo])
        state, total = 0, 0
        for k in range(len(at)):
            if state == entry[k]:
                state, total = int(leave[k]), total + int(grown[k])
                continue
            one = self.advance(word, at[k : k + 1], size[k : k + 1], np.array([state]))
            state, total = int(one[0][0]), total + int(one[1][0])
        return total


class Tokens:
    """Both machines."""

    def __init__(self, model: Model):
        self.model, self.counter = model, Counter(model)
        to, mark = splitter()
        # a document's first character starts from no open word, whatever came before
        self.to = np.concatenate([to, np.repeat(to[:, :1], STATES, 1)])
        self.mark = np.concatenate([mark, np.repeat(mark[:, :1], STATES, 1)])
        self.width = np.ones(256, np.uint8)
        self.fresh = REST + 1

    def _symbols(self, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Input symbols of the characters; ``first``: a text starts here."""
        end = np.full(2, 255, np.uint8)
        nxt = np.concatenate([kind[1:], end[:1]])
        after = np.concatenate([kind[2:], end])[: len(kind)]
        stop = np.concatenate([first[1:], [True]]) | (nxt == C["special"])
        nxt = np.where(stop, 255, nxt)
        after = np.where(np.concatenate([first[2:], [True, True]])[: len(kind)] | stop, 255, after)
        symbol = np.full(len(kind), OTHER, np.uint8)
        symbol[(kind == C["letter"]) | ((kind >= C["stmd"]) & (kind <= C["l"]))] = LETTER
        symbol[kind == C["number"]] = NUMBER
        quote = kind == C["apostrophe"]
        symbol[quote & (nxt == C["stmd"])] = SHORT
        symbol[quote & (((nxt == C["rv"]) & (after == C["e"])) | ((nxt == C["l"]) & (after == C["l"])))] = LONGER
        white = (kind == C["blank"]) | (kind == C["space"])
        more = (nxt == C["blank"]) | (nxt == C["space"])
        symbol[white & more] = INNER
        symbol[white & stop] = LAST
        symbol[white & ~more & ~stop] = SINGLE
        symbol[(kind == C["space"]) & ~more & ~stop] = SPACE
        symbol[kind == C["special"]] = REST
        return symbol

    def words(self, symbol: np.ndarray) -> np.ndarray:
        """True where a word begins: chunk maps, their scan, then the marks."""
        n = len(symbol)
        lanes = -(-n // CHUNK)
        grid = np.full(lanes * CHUNK, REST, np.uint8)
        grid[:n] = symbol
        grid = np.ascontiguousarray(grid.reshape(lanes, CHUNK).T)
        flat = self.to.ravel()
        maps = np.tile(np.arange(STATES, dtype=np.uint8), (lanes, 1))
        for p in range(CHUNK):
            maps = flat[(grid[p].astype(np.int32) << 3)[:, None] + maps]
        state = np.concatenate([[0], composed(maps)[:-1, 0]]).astype(np.int32)
        marks = np.empty((CHUNK, lanes), bool)
        flat_mark = self.mark.ravel()
        for p in range(CHUNK):
            edge = (grid[p].astype(np.int32) << 3) + state
            marks[p] = flat_mark[edge]
            state = flat[edge].astype(np.int32)
        return marks.T.ravel()[:n]

    def count(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Tokens of each text; ``data``: UTF-8 of all, ``off``: their edges."""
        out = np.zeros(len(off) - 1, np.int64)
        if not len(data):
            return out
        if len(self.counter.states) > MAX_STATES:
            self.counter.clear()
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # a character's first byte
        cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kind = self.model.kinds[cp]
        doc = np.searchsorted(off, lead, side="right") - 1
        first = np.concatenate([[True], doc[1:] != doc[:-1]])
        heads = self._specials(data, off, lead, kind)
        symbol = self._symbols(kind, first)
        symbol[heads] = SPECIAL
        symbol[first] += self.fresh
        begin = np.flatnonzero(self.words(symbol))
        at = lead[begin]
        size = np.diff(np.append(at, len(data)))
        n = np.ones(len(at), np.int64)
        plain = np.flatnonzero(~np.isin(begin, heads)) if len(heads) else np.arange(len(at))
        n[plain] = self.counter.count(data, at[plain], size[plain])
        return np.bincount(doc[begin], weights=n, minlength=len(out)).astype(np.int64)

    def _specials(self, data: np.ndarray, off: np.ndarray, lead: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Mark the characters of special tokens in ``kind``; the first character of each."""
        import re

        if not self.model.special:
            return np.zeros(0, np.int64)
        raw, heads = data.tobytes(), []
        for m in re.finditer(b"|".join(map(re.escape, self.model.special)), raw):
            # not over the edge of two texts
            if np.searchsorted(off, m.start(), side="right") == np.searchsorted(off, m.end() - 1, side="right"):
                a, b = np.searchsorted(lead, [m.start(), m.end()])
                kind[a:b] = C["special"]
                heads.append(a)
        return np.array(heads, np.int64)


def machines(model: Model) -> Tokens:
    """A worker's machines, kept between its tasks."""
    kept = sys.__dict__.setdefault("agora_token_machines", {})
    if model.key not in kept:
        kept.clear()
        kept[model.key] = Tokens(model)
    return kept[model.key]


def _count(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = machines(model)
        for batch in batches:
            data, off = as_bytes(batch.column("text"))
            for i, j in slices(off, SLICE):
                part = off[i : j + 1] - off[i]
                n = tokens.count(data[off[i] : off[j]], part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i).cast(pa.int64()), pa.array(np.diff(part), pa.int64()), pa.array(n, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    return run


def counted(docs: DataFrame, model: str = MODEL, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document."""
    rows = docs.select("doc_id", "text").mapInArrow(_count(load(model)), "doc_id long, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)

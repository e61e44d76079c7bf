"""Language-model scoring: corpus word counts and a causal self-attention model.

Base.  Tokens are lower-cased words and one end for each text.  Blocks of documents
send their distinct words with training counts to buckets by word hash; the buckets
answer each block with corpus-wide counts.  The counts cover all training documents.

Model.  A word is a run of subword ids of a public byte-level tokenizer (its file is a
parameter); a token is an id and whether it starts a word, or the end.  The model
predicts the class of the next token by one causal self-attention layer over the
tokens before it, and the token within its class by corpus counts.  A word's
probability mixes that of its tokens with its share of all training words (KNOWN).

Training covers all training documents and gathers no text on the driver.  Classes are
clusters of tokens by hashed counts of what precedes them, summed over every token.
Every window of every training document trains the attention.  The windows of blocks
with about PART_TOKENS tokens train one copy of the weights in numpy, by Adam; the copies
are averaged by their windows and go on from there.  Each of the ROUNDS takes windows of
its own, together all.  Packed sums go through FAN partial sums.  A block keeps its texts
as numbers of words, from which training and scoring take their windows; only counts of
words go to buckets.

Scoring.  A text's tokens are cut into windows of CONTEXT + STRIDE inputs that overlap
by CONTEXT; each window scores its last STRIDE tokens, so every token is scored once,
with CONTEXT to CONTEXT + STRIDE - 1 tokens before it (fewer at the text's start).
Windows go through the masked attention in batches.

Held-out documents (crc32 of the id, modulo 10, is 0) train nothing.  Null or empty
text: the end alone.  Repeated rows each count and are scored alike.  Without training
documents counts are 0 and the model is uniform.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm import blocks as bl
from agora.llm.common import as_bytes, hash_words, lower, mix64, slices, stored, word_spans

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# splits a word (it has no white space) before the merges of the rank file; fixed value of that tokenizer
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s"
HELD_OUT = 0  # crc32 of the id, modulo 10
EVERY = 1  # of a text's windows thinned by a seed; 1 keeps all
ROUNDS = 2
PART_TOKENS = 4 << 20
SLICE_WORDS = 1 << 17  # that a task turns into tokens at once
STEPS = 125  # of a copy in a round, at least
FAN = 32
CONTEXTS = 512  # hashes of the token before
CONTEXT = STRIDE = 16
DIM = 16
CLASSES = 96
FREQUENT = 4096  # tokens with an embedding of their own
SHARED = 256  # embeddings that the others share by id
BATCH = 256
TRAIN_BATCH = 256
SMOOTH = 0.1
KNOWN = 0.3  # weight of a word's own share of the corpus in its probability

TOKENS, WORDS, PAIRS, TEXTS = -1, -2, -3, -4  # in place of a block: what a packed row holds

SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


class Subwords:
    """Subword ids of words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.size = ranks, max(ranks.values()) + 2
        self.end = 2 * self.size - 1  # the end token; others are 2 * id + (starts a word)

    def _encoding(self):
        import tiktoken

        # one encoding in a worker process, whatever the number of its tasks
        kept = tiktoken.__dict__.setdefault("_kept_encodings", {})
        key = (len(self.ranks), SPLIT)
        if key not in kept:
            kept[key] = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=self.ranks, special_tokens={})
        return kept[key]

    def tokens(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words, one after the other, and how many each has."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        line = self.ranks[b"\n"]
        text = b"\n".join(words).decode("utf-8", "replace")
        ids = self._encoding().encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.int64)
        apart = ids == line
        n = np.diff(np.concatenate([[-1], np.flatnonzero(apart), [len(ids)]])) - 1
        first = np.concatenate([[True], apart[:-1]])
        return (2 * ids + first)[~apart], n


def read_ranks(path: str = TOKENIZER) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """np.unique of hashes, with the first place of each and the number of each entry, by
    sorting leading bits beside the place (hashes that share all of these: by np.unique)."""
    bits = np.uint64(max(1, len(h)).bit_length())
    key = h >> bits << bits | np.arange(len(h), dtype=np.uint64)
    key.sort()
    order = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    rising = h[order]
    if (rising[1:] < rising[:-1]).any():
        return np.unique(h, return_index=True, return_inverse=True)
    new = np.ones(len(h), bool)
    new[1:] = rising[1:] != rising[:-1]
    of = np.empty(len(h), np.int64)
    of[order] = np.cumsum(new) - 1
    return rising[new], order[new], of


class Words:
    """The lower-cased words of a block: distinct ones, and each word's number."""

    def __init__(self, t: pa.Table):
        data, off = as_bytes(t["text"])
        data = lower(data)
        h, where, self.doc = [], [], []
        for i, j in slices(off):
            d, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
            s, e, doc = word_spans(d, o)
            h.append(hash_words(d, s, e))
            where.append(np.stack([s + off[i], e + off[i]]))
            self.doc.append(doc + i)
        self.doc = np.concatenate(self.doc) if self.doc else np.zeros(0, np.int64)
        h = np.concatenate(h) if h else np.zeros(0, np.uint64)
        self.hash, first, self.of = distinct(h)
        raw = data.tobytes()
        at = np.concatenate(where, 1)[:, first] if where else np.zeros((2, 0), np.int64)
        self.text = [raw[a:b] for a, b in zip(at[0].tolist(), at[1].tolist())]
        self.n_docs = t.num_rows


def planes(x: np.ndarray) -> np.ndarray:
    """The bytes of 32-bit numbers, first all lowest ones: so they compress better."""
    return x.astype(np.int32).view(np.uint8).reshape(-1, 4).T.ravel()


def from_planes(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.reshape(4, -1).T).view(np.int32).ravel()


class Texts:
    """A block's texts as numbers of words: the documents' ids and numbers of words, each
    word's number, the tokens of the distinct words and how many each has."""

    def __init__(self, ids: list, n_words: np.ndarray, of: np.ndarray, tok: np.ndarray, n: np.ndarray):
        self.ids, self.n_words, self.of, self.tok, self.n = ids, n_words, of, tok, n
        self.n_docs, self.doc = len(ids), np.repeat(np.arange(len(ids)), n_words)

    def slices(self) -> Iterator[Texts]:
        """The documents in runs of about SLICE_WORDS words, one at least."""
        edge = np.concatenate([[0], np.cumsum(self.n_words)])
        for i, j in slices(edge, SLICE_WORDS):
            yield Texts(self.ids[i:j], self.n_words[i:j], self.of[edge[i] : edge[j]], self.tok, self.n)

    def packed(self) -> bytes:
        cols = {"ids": pa.array(self.ids, pa.int64())}
        cols |= {c: pa.array(planes(getattr(self, c))) for c in ("n_words", "of", "tok", "n")}
        batch = pa.record_batch({c: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for c, v in cols.items()})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    @staticmethod
    def unpacked(blob: bytes) -> Texts:
        t = pa.ipc.open_stream(blob).read_next_batch()
        rest = (from_planes(t[c].values.to_numpy()) for c in ("n_words", "of", "tok", "n"))
        return Texts(t["ids"].values.to_pylist(), *rest)


def _trains(ids: list) -> np.ndarray:
    """Which documents train; a null id, having no remainder, does not."""
    return np.array([x is not None and zlib.crc32(str(x).encode()) % 10 != HELD_OUT for x in ids], bool)


def token_runs(w: Words | Texts, tok: np.ndarray, n: np.ndarray, end: int) -> tuple[np.ndarray, ...]:
    """Tokens of all texts with an end after each, the number of each text's, which ones
    are no ends, and the number of each word's."""
    # the end is one more word, of one token
    of = np.full(len(w.of) + w.n_docs, len(n), np.int64)
    of[np.arange(len(w.of)) + w.doc] = w.of
    tok, n = np.append(tok, tok.dtype.type(end)), np.append(n, n.dtype.type(1))
    each = n[of]
    start = np.cumsum(each) - each
    seq = tok[np.arange(int(each.sum())) + np.repeat((np.cumsum(n) - n)[of] - start, each)]
    per_word = n[w.of]
    n_tok = np.bincount(w.doc, weights=per_word, minlength=w.n_docs).astype(np.int64) + 1
    inside = np.ones(len(seq), bool)
    inside[np.cumsum(n_tok) - 1] = False
    return seq, n_tok, inside, per_word


def contexts(seq: np.ndarray, sub: Subwords) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (token, hash of the token before) and their counts; an end stands before
    each text."""
    hashed = (mix64(np.arange(2 * sub.size, dtype=np.uint64)) % np.uint64(CONTEXTS)).astype(np.int32)
    before = np.concatenate([[sub.end], seq[:-1]]) if len(seq) else seq
    return np.unique(seq.astype(np.int32) * np.int32(CONTEXTS) + hashed[before], return_counts=True)


def _ask_counts(n_buckets: int, sub: Subwords):
    def ask(key: tuple, t: pa.Table) -> pa.Table:
        block, w = key[0].as_py(), Words(t)
        ids = t["doc_id"].to_pylist()
        trains = _trains(ids)
        count = np.bincount(w.of, weights=trains[w.doc], minlength=len(w.hash)).astype(np.uint32)
        rows = [
            (b, block, w.hash[i:j].tobytes() + count[i:j].tobytes()) for b, i, j in bl.cuts(bl.bucket_of(w.hash, n_buckets))
        ]
        tok, n = sub.tokens(w.text)
        used = np.bincount(tok, weights=np.repeat(count, n), minlength=2 * sub.size).astype(np.int64)
        used[sub.end] += trains.sum()
        seq, n_tok, _, _ = token_runs(w, tok, n, sub.end)
        seq, n_tok = seq[np.repeat(trains, n_tok)], n_tok[trains]
        pair, times = contexts(seq, sub)
        own = -1 - block
        return bl.asked(
            [
                *rows,
                (own, TOKENS, used.tobytes()),
                (own, PAIRS, pair.astype(np.int32).tobytes() + times.astype(np.uint32).tobytes()),
                (own, TEXTS, Texts(ids, np.bincount(w.doc, minlength=w.n_docs), w.of, tok, n).packed()),
            ]
        )

    return ask


def _count(key: tuple, t: pa.Table) -> pa.Table:
    """Corpus counts of a bucket's words; block WORDS: the bucket's number of trained
    words, and of trained tokens without ends."""
    bucket = key[0].as_py()
    block, blob = t["block"].to_pylist(), t["blob"].to_pylist()
    sets = [(np.frombuffer(x[: len(x) // 3 * 2], np.uint64), np.frombuffer(x[len(x) // 3 * 2 :], np.uint32)) for x in blob]
    at = np.cumsum([0, *(len(h) for h, _ in sets)])
    uniq, back = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True)
    total = np.bincount(back, weights=np.concatenate([c for _, c in sets]), minlength=len(uniq)).astype(np.int64)
    rows = [(block[i], bucket, total[back[at[i] : at[i + 1]]].tobytes()) for i in range(len(sets))]
    return bl.answered([*rows, (WORDS, bucket, np.array([(total > 0).sum(), total.sum()], np.int64).tobytes())])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None  # of all arrays of this task
    for batch in batches:
        for x in batch.column("blob").to_pylist():
            c = np.frombuffer(x, np.int64)
            total = c.copy() if total is None else total + c
    if total is not None:
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], ["k", "c"])


def _totals(packed: DataFrame, block: int) -> dict[int, int]:
    """Sums by place of the packed arrays (places: tokens of the vocabulary, or two)."""
    rows = packed.filter(F.col("block") == block).select("blob").mapInArrow(_unpacked, "k long, c long")
    return {r["k"]: r["c"] for r in rows.groupBy("k").agg(F.sum("c").alias("c")).collect()}


# ---- the model -------------------------------------------------------------


def _pack(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x, np.float64).tobytes(), codec="zstd", asbytes=True)


def _unpack(x: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(x, decompressed_size=8 * size, codec="zstd", asbytes=True), np.float64)


def _packed(part: int, x: np.ndarray) -> pa.Table:
    return pa.table({"part": pa.array([part], pa.int64()), "blob": pa.array([_pack(x)], pa.binary())})


def summed(rows: DataFrame, size: int) -> np.ndarray:
    """Sum of the packed arrays (part, blob), always in the order of parts; the driver
    gets one array of ``size`` numbers."""

    def add(key: tuple, t: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for x in t.combine_chunks().sort_by("part")["blob"]:
            total += _unpack(x.as_py(), size)
        return _packed(key[0].as_py(), total)

    for slot in (F.pmod("part", F.lit(FAN)), F.lit(0).cast("long")):
        rows = rows.withColumn("slot", slot).groupBy("slot").applyInArrow(add, "part long, blob binary")
    got = rows.first()
    return _unpack(got["blob"], size) if got else np.zeros(size)


def _frequent_contexts(place: np.ndarray):
    """Of a task's contexts, the counts of the tokens with an embedding of their own."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = None, 0
        for batch in batches:
            for k, x in zip(batch.column("part").to_pylist(), batch.column("blob").to_pylist()):
                half = len(x) // 2
                pair, times = np.frombuffer(x[:half], np.int32), np.frombuffer(x[half:], np.uint32)
                at = place[pair // CONTEXTS].astype(np.int64)
                own = at < FREQUENT
                c = np.bincount(at[own] * CONTEXTS + pair[own] % CONTEXTS, weights=times[own], minlength=FREQUENT * CONTEXTS)
                part, total = (k, c) if total is None else (min(part, k), total + c)
        if total is not None:
            yield from _packed(part, total).to_batches()

    return sums


def clusters(x: np.ndarray, top: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Class of each token: k-means of the frequent ones ``top`` over their contexts ``x``
    (a row each); the others by id."""
    of = (np.arange(len(count)) % CLASSES).astype(np.int64)
    x, top = x[count[top] > 0], top[count[top] > 0]
    if len(top) < CLASSES:
        return of
    weight = x.sum(1)
    x = np.sqrt(x / np.maximum(weight, 1)[:, None])
    centre = x[:CLASSES].copy()
    for _ in range(15):
        near = np.argmax(x @ centre.T - 0.5 * (centre**2).sum(1), 1)
        for k in range(CLASSES):
            own = near == k
            if own.any():
                centre[k] = np.average(x[own], axis=0, weights=weight[own] + 1e-9)
    of[top] = near
    return of


def windows(seq: np.ndarray, n: np.ndarray, end: int, seed: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Inputs (windows x CONTEXT + STRIDE, -1 outside the text), targets (windows x STRIDE,
    -1 outside) and the document of each window; the input before the first token is the end.
    ``seed``: a number for each document, by which one window of every EVERY is taken."""
    edge = np.cumsum(n) - n
    n_win = -(-n // STRIDE)
    doc = np.repeat(np.arange(len(n)), n_win)
    at = (np.arange(len(doc)) - np.repeat(np.cumsum(n_win) - n_win, n_win)) * STRIDE
    if seed is not None:
        first = seed % np.minimum(EVERY, np.maximum(n_win, 1))
        take = at // STRIDE % EVERY == first[doc]
        doc, at = doc[take], at[take]
    i = at[:, None] - CONTEXT + np.arange(CONTEXT + STRIDE)
    fits = (i >= 0) & (i < n[doc][:, None])
    j = np.where(fits, edge[doc][:, None] + i, 0)
    x = np.where(fits, np.where(i == 0, end, seq[np.maximum(j - 1, 0)]), -1)
    y = np.where(fits, seq[j], -1)[:, CONTEXT:]
    return x, y, doc


def laid_out(seq: np.ndarray, n: np.ndarray, end: int) -> tuple[np.ndarray, ...]:
    """Inputs and targets of all texts one after the other, each filled up to whole strides
    by -1, CONTEXT times -1 before the inputs; the place of each token among the targets; of
    each stride, whether it begins a text.  What ``spans`` makes of the inputs are the
    windows, but a text's first one begins with the last inputs of another."""
    n_win, edge = -(-n // STRIDE), np.cumsum(n) - n
    begin = np.cumsum(n_win) - n_win
    at = np.arange(len(seq)) + np.repeat(begin * STRIDE - edge, n)
    y = np.full(int(n_win.sum()) * STRIDE, -1, np.int32)
    x = np.full(CONTEXT + len(y), -1, np.int32)
    y[at] = seq
    x[CONTEXT + at[1:]] = seq[:-1]
    x[CONTEXT + at[edge]] = end
    first = np.zeros(len(y) // STRIDE, bool)
    first[begin] = True
    return x, y, at, first


def spans(x: np.ndarray) -> np.ndarray:
    """Each run of CONTEXT + STRIDE rows of x that begins at a multiple of STRIDE, not copied."""
    shape = (max(0, (len(x) - CONTEXT) // STRIDE), CONTEXT + STRIDE, *x.shape[1:])
    return np.lib.stride_tricks.as_strided(x, shape, (STRIDE * x.strides[0], *x.strides), writeable=False)


def round_windows(blob: bytes, end: int, first: int, step: int) -> tuple[np.ndarray, int]:
    """The rows (inputs, targets) of every ``step``-th window of a block's training documents
    from ``first`` on, and the number of all windows."""
    rows, total = [np.zeros((0, CONTEXT + 2 * STRIDE), np.int32)], 0
    for w in Texts.unpacked(blob).slices():
        seq, n, _, _ = token_runs(w, w.tok, w.n, end)
        trains = _trains(w.ids)
        x, y, _, begins = laid_out(seq[np.repeat(trains, n)], n[trains], end)
        take = slice((first - total) % step, None, step)
        rows.append(np.concatenate([spans(x)[take], y.reshape(-1, STRIDE)[take]], 1))
        rows[-1][begins[take], :CONTEXT] = -1
        total += len(begins)
    return np.concatenate(rows), total


def trained_windows(blob: bytes, end: int) -> np.ndarray:
    """The rows (inputs, targets) of all windows of a block's training documents."""
    return round_windows(blob, end, 0, 1)[0]


_ROW, _COL = np.arange(STRIDE)[:, None] + CONTEXT, np.arange(CONTEXT + STRIDE)
_BACK = np.maximum(_ROW - _COL, 0)  # how far back a key is
_SEES = _COL <= _ROW
_SEEN = _SEES.astype(np.float32)
_TWOS = np.arange((FREQUENT + SHARED) * DIM // 2).reshape(-1, DIM // 2)  # places of each embedding's numbers, two taken as one


def _exp(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp (in place) of x less a number, one for each row, by which no row overflows or
    vanishes; and that number."""
    top = x.max()
    top = top if top - x.min() < 80 else x.max(-1, keepdims=True)
    x -= top
    return np.exp(x, out=x), top


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, all rows one after the other."""
    return x.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], np.float32)


def _exp_sums(x: np.ndarray, out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """exp of x less a number, row sums of that, and the number: 0 for all rows unless
    one overflows or vanishes."""
    with np.errstate(over="ignore"):
        e = np.exp(x, out=out)
    total = _sums(e)
    if _fair(total):
        return e, total, 0.0
    e, top = _exp(x.copy())
    return e, _sums(e), np.ravel(top)


def _fair(total: np.ndarray) -> bool:
    return bool(1e-30 < total.min() and total.max() < 1e30)


def _attention(q: np.ndarray, e: np.ndarray, bias: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Attention of each window's last STRIDE inputs to all its embeddings ``e``, and what
    it gathers of them; ``first``: the windows that begin a text, CONTEXT inputs before it."""
    a = q @ e.transpose(0, 2, 1)
    a += bias
    with np.errstate(over="ignore", invalid="ignore"):
        w = np.exp(a)
        w *= _SEEN
    w[first, :, :CONTEXT] = 0
    total = _sums(w)
    if not _fair(total):
        a[:, ~_SEES] = a[first, :, :CONTEXT] = -np.inf
        w, _ = _exp(a)
        total = _sums(w)
    w *= (1 / total).reshape(-1, STRIDE, 1)
    return w, w @ e


def _weights(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Q K', of which attention between embeddings is made, and what makes logits of gathered
    embeddings, the input's embedding and 1: no input has keys and values of its own."""
    return p["Q"] @ p["K"].T, np.concatenate([p["V"] @ p["O"], p["R"], p["C"][None]])


def attend(p: dict[str, np.ndarray], x: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Class logits of each window's last STRIDE inputs, and what the gradient needs: ``he``
    is the embeddings that attention gathers, the input's embedding and 1."""
    at = place.take(np.maximum(x, 0))
    e = p["E"].take(at, 0)
    between, to_logits = _weights(p)
    q = (p["E"] @ between).take(at[:, CONTEXT:], 0)
    a, h = _attention(q, e, p["B"][_BACK], np.flatnonzero(x[:, 0] < 0))
    he = np.ones((len(x), STRIDE, 2 * DIM + 1), np.float32)
    he[:, :, :DIM], he[:, :, DIM:-1] = h, e[:, CONTEXT:]
    he = he.reshape(-1, 2 * DIM + 1)
    return (he @ to_logits).reshape(len(x), STRIDE, CLASSES), (at, e, q, a, h, he)


def first_weights(of: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
    """Weights before training: those of a model that knows the classes' shares only."""
    g = np.random.default_rng(7)
    f = lambda *shape: (g.standard_normal(shape) * 0.1).astype(np.float32)
    prior = np.bincount(of, weights=count, minlength=CLASSES) + 1.0
    p = {
        "E": f(FREQUENT + SHARED, DIM), "Q": f(DIM, DIM), "K": f(DIM, DIM), "V": f(DIM, DIM), "B": np.zeros(CONTEXT + STRIDE, np.float32),
        "O": f(DIM, CLASSES), "R": f(DIM, CLASSES), "C": np.log(prior / prior.sum()).astype(np.float32),
    }
    return p if count.any() else {k: np.zeros_like(w) for k, w in p.items()}


def train(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, place: np.ndarray, of: np.ndarray, turn: int) -> dict[str, np.ndarray]:
    """The weights after a pass over the windows (STEPS steps at least), by Adam on
    cross-entropy of the next token's class."""
    order = np.random.default_rng(turn).permutation(len(x))
    steps = max(STEPS, -(-len(x) // TRAIN_BATCH))
    flat = _flat(p)
    slope, m, s2 = (np.zeros_like(flat) for _ in range(3))
    p, grad = _views(flat, p), _views(slope, p)
    embeddings, scratch = grad["E"].reshape(-1).view(np.complex64), np.empty((TRAIN_BATCH * STRIDE, CLASSES), np.float32)
    for step in range(1, steps + 1):
        pick = order.take(np.arange((step - 1) * TRAIN_BATCH, step * TRAIN_BATCH), mode="wrap")
        xb, target = x[pick], y[pick].ravel()
        between, to_logits = _weights(p)
        z, (at, e, q, a, h, he) = attend(p, xb, place)
        d, total, _ = _exp_sums(z.reshape(-1, CLASSES), scratch)
        live = np.flatnonzero(target >= 0)
        each = np.float32(1 / max(1, len(live)))
        share = np.zeros(len(d), np.float32)
        share[live] = each / total[live]
        d *= share[:, None]
        d.reshape(-1)[live * CLASSES + of[target[live]]] -= each
        dhe = (d @ to_logits[:-1].T).reshape(len(xb), STRIDE, 2 * DIM)
        dh = np.ascontiguousarray(dhe[:, :, :DIM])
        ds = dh @ e.transpose(0, 2, 1)
        ds -= _sums(dh * h).reshape(-1, STRIDE, 1)
        ds *= a
        dq = (ds @ e).reshape(-1, DIM)
        de = np.concatenate([ds, a], 1).transpose(0, 2, 1) @ np.concatenate([q, dh], 1)
        late = (dq @ between.T).reshape(dh.shape)
        late += dhe[:, :, DIM:]
        de[:, CONTEXT:] += late
        dout, dbetween = he.T @ d, he[:, DIM:-1].T @ dq
        grad["Q"][:], grad["K"][:] = dbetween @ p["K"], dbetween.T @ p["Q"]
        grad["V"][:], grad["O"][:] = dout[:DIM] @ p["O"].T, p["V"].T @ dout[:DIM]
        grad["R"][:], grad["C"][:] = dout[DIM:-1], dout[-1]
        grad["B"][:] = np.bincount(_BACK.ravel(), weights=ds.sum(0).ravel(), minlength=CONTEXT + STRIDE)
        embeddings[:] = 0
        np.add.at(embeddings, _TWOS.take(at.ravel(), 0).ravel(), de.reshape(-1).view(np.complex64))
        rate = 0.02 / (turn + 1) * min(1.0, 2 * (1 - step / (steps + 1)))
        m *= 0.9
        m += 0.1 * slope
        s2 *= 0.99
        slope *= slope
        slope *= 0.01
        s2 += slope
        root = np.sqrt(s2)
        root *= (1 - 0.99**step) ** -0.5
        root += 1e-8
        np.divide(m, root, out=root)
        root *= rate / (1 - 0.9**step)
        flat -= root
    return p


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _views(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The parts of ``flat``, laid out as by _flat."""
    end = np.cumsum([like[k].size for k in sorted(like)])
    return {k: part.reshape(like[k].shape) for k, part in zip(sorted(like), np.split(flat, end[:-1]))}


def _rows_of_round(blob: bytes, first: int) -> tuple[np.ndarray, int]:
    """Every ROUNDS-th of the packed windows from ``first`` on, and the number of all."""
    rows = np.frombuffer(blob, np.int32).reshape(-1, CONTEXT + 2 * STRIDE)
    return rows[first::ROUNDS], len(rows)


def _train_part(p: dict[str, np.ndarray], place: np.ndarray, of: np.ndarray, turn: int, read=_rows_of_round):
    """A part's number of windows in this round, and that times its weights after them;
    ``read`` gives a blob's windows of the round, every ROUNDS-th, and the number of all."""
    span = CONTEXT + STRIDE

    def run(key: tuple, t: pa.Table) -> pa.Table:
        own, at = [], 0
        for i in pa.compute.sort_indices(t["bucket"]).to_pylist():
            rows, n = read(t["blob"][i].as_buffer(), (turn - at) % ROUNDS)
            own.append(rows)
            at += n
        own = np.concatenate(own) if len(own) > 1 else own[0]
        if not len(own):
            return _packed(0, np.zeros(0)).slice(0, 0)
        after = train(p, own[:, :span], own[:, span:], place, of, turn)
        return _packed(key[0].as_py(), len(own) * np.concatenate([[1.0], _flat(after)]))

    return run


class Model:
    def __init__(self, sub: Subwords, count: np.ndarray, asked: DataFrame):
        """``count``: of each token over all training documents; ``asked``: the packed
        contexts and texts of the blocks."""
        self.end = end = sub.end
        size = 2 * sub.size
        top = np.argsort(-count, kind="stable")[:FREQUENT]
        self.place = (FREQUENT + np.arange(size) % SHARED).astype(np.int16)
        self.place[top] = np.arange(len(top))
        pairs = asked.filter(F.col("block") == PAIRS).select((-1 - F.col("bucket")).alias("part"), "blob")
        x = summed(pairs.mapInArrow(_frequent_contexts(self.place), "part long, blob binary"), FREQUENT * CONTEXTS)
        self.of = clusters(x.reshape(FREQUENT, CONTEXTS), top, count).astype(np.int16)
        self.p = first_weights(self.of, count)
        own = asked.filter(F.col("block") == TEXTS)
        own = own.select(F.pmod(-1 - F.col("bucket"), F.lit(max(1, int(count.sum()) // PART_TOKENS))).alias("part"), "bucket", "blob")
        for turn in range(ROUNDS):
            read = lambda blob, first: round_windows(blob, end, first, ROUNDS)
            step = _train_part(self.p, self.place, self.of.astype(np.int64), turn, read)
            copies = own.groupBy("part").applyInArrow(step, "part long, blob binary")
            total = summed(copies, 1 + sum(w.size for w in self.p.values()))
            if total[0]:
                self.p = _views((total[1:] / total[0]).astype(np.float32), self.p)
        mass = count + SMOOTH
        self.within = np.log(mass / np.bincount(self.of, weights=mass, minlength=CLASSES)[self.of]).astype(np.float32)

    def score(self, seq: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Natural log probability of every token, each run (text) by itself."""
        x, y, at, first = laid_out(seq, n, self.end)
        place, of, e = self.place.take(np.maximum(x, 0)), self.of.take(np.maximum(y, 0)), self.p["E"]
        between, to_logits = _weights(self.p)
        # what an input gives depends on its embedding alone
        q, rest = e @ between, e @ to_logits[DIM:-1] + to_logits[-1]
        bias, scratch = self.p["B"][_BACK], np.empty((BATCH * STRIDE, CLASSES), np.float32)
        ll = np.empty(len(y), np.float32)
        for b in range(0, len(first), BATCH):
            begins = np.flatnonzero(first[b : b + BATCH])
            i, j = b * STRIDE, min(b + BATCH, len(first)) * STRIDE
            late = place[CONTEXT + i : CONTEXT + j]
            own = spans(e.take(place[i : CONTEXT + j], 0))
            _, h = _attention(q.take(late, 0).reshape(-1, STRIDE, DIM), own, bias, begins)
            z = h.reshape(-1, DIM) @ to_logits[:DIM]
            z += rest.take(late, 0)
            ll[i:j] = z.reshape(-1).take(np.arange(j - i) * CLASSES + of[i:j])
            _, total, top = _exp_sums(z, scratch[: j - i])
            ll[i:j] -= top + np.log(total)
        return ll[at] + self.within.take(seq)


def _score(model: Model, trained: int, words: int, ends: int):
    def score(key: tuple, t: pa.Table) -> pa.Table:
        of_texts = pa.compute.less(t["bucket"], 0)
        w = Texts.unpacked(t.filter(of_texts)["blob"][0].as_py())
        count = np.frombuffer(b"".join(bl.in_order(t.filter(pa.compute.invert(of_texts)))), np.int64)
        below = np.log10(trained + 0.1 * (words + 1))
        share = lambda c: np.log(np.maximum(KNOWN * np.asarray(c, float) / max(trained, 1), 1e-300))
        rest = np.log(1 - KNOWN if trained else 1.0)
        base, known, model_score = [], [], []
        for d in w.slices():
            by_doc = lambda x: np.bincount(d.doc, weights=x, minlength=d.n_docs)  # noqa: B023, E731
            base.append(by_doc(np.log10(count + 0.1)[d.of]) + np.log10(ends + 0.1))
            known.append(by_doc((count > 0)[d.of]).astype(np.int64) + int(ends > 0))
            seq, n_tok, inside, per_word = token_runs(d, d.tok, d.n, model.end)
            # each word (and the end) by the mixture of its tokens' and its own probability
            ll = model.score(seq, n_tok)
            by_word = np.bincount(np.repeat(np.arange(len(d.of)), per_word), weights=ll[inside], minlength=len(d.of))
            word = np.logaddexp(rest + by_word, share(count)[d.of])
            last = np.logaddexp(rest + ll[~inside], share([ends]))
            model_score.append((by_doc(word) + last) / np.log(10))
        base, known, model_score = (np.concatenate(x) for x in (base, known, model_score))
        return pa.table(
            {
                "doc_id": pa.array(w.ids, pa.int64()),
                "held_out": pa.array([x is not None and zlib.crc32(str(x).encode()) % 10 == HELD_OUT for x in w.ids]),
                "n_tokens": pa.array(w.n_words + 1, pa.int64()), "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array(np.full(len(w.ids), trained, np.int64)),
                "base_score": pa.array(base - (w.n_words + 1) * below), "score": pa.array(model_score),
            }
        )

    return score


def scored(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Base and model scores of every row."""
    sub = Subwords(read_ranks(tokenizer))
    d, n = bl.blocks(docs)
    # what a block counts alone, and its texts, are read where they were written
    asked = stored(d.groupBy("block").applyInArrow(_ask_counts(n, sub), bl.ASKED), "lm-asked")
    counts = asked.filter("bucket >= 0").groupBy("bucket").applyInArrow(_count, bl.ANSWERED)
    answers = stored(counts, "lm-counts")
    used = _totals(asked, TOKENS)
    count = np.zeros(2 * sub.size, np.int64)
    count[list(used)] = list(used.values())
    total = _totals(answers, WORDS)
    ends = int(count[sub.end])
    model = Model(sub, count, asked)
    texts = asked.filter(F.col("block") == TEXTS).select((-1 - F.col("bucket")).alias("block"), "bucket", "blob")
    own = texts.union(answers.filter("block >= 0"))
    return own.groupBy("block").applyInArrow(_score(model, total.get(1, 0) + ends, total.get(0, 0) + (ends > 0), ends), SCHEMA)

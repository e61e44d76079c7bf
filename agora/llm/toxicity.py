"""Toxicity by weak supervision.

1. Features.  A document's features are its words (runs of letters, A-Z lower-cased)
   and the 4, 5 and 6 byte prefixes of longer words.  Spark counts each feature's
   toxic and clean documents, counting copies once; the FEATURES whose log-odds differ
   most from 0, in standard errors, are kept.
2. Voters.  The toxic-leaning words are dealt into lexicons and the prefixes into
   patterns, each a voter that fires when the document has one of its entries; a few
   voters look at the writing itself (shouting, symbols, no toxic-leaning entry), and
   the annotators' label of a training row is one more.
3. Label model.  Expectation maximisation fits P(voter fires | label) for every voter.
   The voters' correlations given the label are estimated from its first step, and
   a voter's vote is shared with those it repeats, so that many copies of one signal
   do not count as many.
4. Classifier.  Logistic regression over the features is trained on the posterior
   labels and scores every document.

Steps 1 to 4 learn from at most SAMPLE labelled documents (smallest id hashes) whose
id is not held out; every document is scored over its whole text.  Labels, language,
source and id are no inputs of a score.

Null or empty text: no features, so it gets the classifier's base rate.  Repeated rows
score alike.  Without labels of both classes every score is the share of toxic labels
(0 without labels).  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.common import as_bytes, crc_mod, hash_words, lower, mix64, slices, stored, word_spans

SAMPLE = 16_000
FEATURES = 4096
LEAST_DOCS = 5  # documents of a feature
LEAST_ODDS = 3.5  # log-odds of a voter's entries: three of four such documents are toxic at a tenth overall
LEAST_Z = 3.0  # and their standard errors from 0
LEXICONS, PATTERNS = 16, 16
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
HELD_OUT = 2  # crc32 of the id, modulo 4

_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[65:91] = _NOT_LETTER[97:123] = _NOT_LETTER[128:] = False
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"!#$%&*<>|")] = True
_BITS = 1 << 18


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature hash) of a slice, with repeats; words have odd hashes, prefixes even ones."""
    data = lower(data)
    starts, ends, doc = word_spans(data, off, _NOT_LETTER)
    one = np.uint64(1)
    out, of = [hash_words(data, starts, ends) | one], [doc]
    for n in PREFIXES:
        longer = ends - starts > n
        s = starts[longer]
        out.append((mix64(hash_words(data, s, s + n) + np.uint64(n)) >> one) << one)
        of.append(doc[longer])
    return np.concatenate(of), np.concatenate(out)


def _distinct(of: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    return of[new], h[new]


def _writing(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Shouting and symbol voters of each text."""
    n = np.maximum(off[1:] - off[:-1], 1)
    share = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[data])])[off]) / n
    return np.stack([share(_UPPER) > 0.3, share(_SYMBOL) > 0.05], 1)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic): at most SAMPLE labelled documents that are not held out."""
    own = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(crc_mod("doc_id", 4) != HELD_OUT)
    own = own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")
    return rows.groupBy(F.sha2("text", 256).alias("h"), "toxic").agg(F.min_by(F.struct("doc_id", "text"), "doc_id").alias("d")).select(
        "d.doc_id", "d.text", "toxic"
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = as_bytes(batch.column("text"))
        toxic = np.asarray(batch.column("toxic").to_pylist(), np.int64)
        for i, j in slices(off, 1 << 22):
            of, h = _distinct(*features(data[off[i] : off[j]], off[i : j + 1] - off[i]))
            uniq, back = np.unique(h, return_inverse=True)
            k = np.bincount(back, weights=toxic[i:j][of], minlength=len(uniq)).astype(np.int64)
            n = np.bincount(back, minlength=len(uniq))
            yield pa.RecordBatch.from_arrays([pa.array(uniq.view(np.int64)), pa.array(k), pa.array(n - k)], ["h", "k", "c"])


def strongest(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and log-odds of the kept features (0: too uncertain for a vote)."""
    totals = train.agg(F.sum("toxic").alias("k"), F.count(F.lit(1)).alias("n")).first()
    k_all, c_all = (totals["k"] or 0), totals["n"] - (totals["k"] or 0)
    counts = train.select("text", "toxic").mapInArrow(_count, "h long, k long, c long").groupBy("h").agg(
        F.sum("k").alias("k"), F.sum("c").alias("c")
    )
    odds = F.log((F.col("k") + 0.5) / (k_all + 1.0)) - F.log((F.col("c") + 0.5) / (c_all + 1.0))
    top = counts.filter(F.col("k") + F.col("c") >= LEAST_DOCS).withColumn("odds", odds)
    top = top.withColumn("z", F.abs("odds") / F.sqrt(1 / (F.col("k") + 0.5) + 1 / (F.col("c") + 0.5)))
    rows = top.orderBy(F.desc("z"), "h").limit(FEATURES).select("h", "odds", "z").collect()
    h = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(h)
    # only features that stand out clearly vote
    sure = np.array([r["odds"] if r["z"] >= LEAST_Z else 0.0 for r in rows], float)
    return h[order], sure[order]


def _match(data: np.ndarray, off: np.ndarray, kept: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature number) pairs of a slice, distinct, by document."""
    of, h = features(data, off)
    can = maybe[(h >> np.uint64(20)) & np.uint64(_BITS - 1)]
    of, h = of[can], h[can]
    at = np.minimum(np.searchsorted(kept, h), max(len(kept) - 1, 0))
    hit = kept[at] == h if len(kept) else np.zeros(0, bool)
    pair = np.unique(of[hit] * FEATURES + at[hit])
    return pair // FEATURES, pair % FEATURES


def _maybe(kept: np.ndarray) -> np.ndarray:
    maybe = np.zeros(_BITS, bool)
    maybe[(kept >> np.uint64(20)) & np.uint64(_BITS - 1)] = True
    return maybe


def _rows(kept: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = _maybe(kept)
        for batch in batches:
            data, off = as_bytes(batch.column("text"))
            for i, j in slices(off):
                d, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
                of, k = _match(d, o, kept, maybe)
                edge = np.searchsorted(of, np.arange(j - i + 1))
                w = _writing(d, o)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(i, j - i), "toxic": batch.column("toxic").slice(i, j - i),
                        "x": [k[edge[n] : edge[n + 1]].tolist() for n in range(j - i)], "w": w.tolist(),
                    },
                    pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("x", pa.list_(pa.int32())), ("w", pa.list_(pa.bool_()))]),
                )

    return rows


def voters(odds: np.ndarray, kept: np.ndarray) -> list[np.ndarray]:
    """Feature numbers of each lexicon (words) and pattern (prefixes), strongest first."""
    rank = [k for k in np.argsort(-odds, kind="stable") if odds[k] >= LEAST_ODDS]
    words = [k for k in rank if int(kept[k]) & 1]
    stems = [k for k in rank if not int(kept[k]) & 1]
    sets = [words[i::LEXICONS] for i in range(LEXICONS)] + [stems[i::PATTERNS] for i in range(PATTERNS)]
    return [np.array(s) for s in sets if s]


def votes(x: list[np.ndarray], writing: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """documents x voters, 0 or 1."""
    out = np.zeros((len(x), len(sets) + 1 + writing.shape[1]))
    of = np.full(FEATURES, -1)
    for v, s in enumerate(sets):
        of[s] = v
    for i, k in enumerate(x):
        v = of[k]
        out[i, v[v >= 0]] = 1
        out[i, len(sets)] = not (v >= 0).any()
    out[:, len(sets) + 1 :] = writing
    return out


def label_model(v: np.ndarray, start: np.ndarray, turns: int = 20, annotators: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior P(toxic) of each row; P(fires | clean, toxic) of each voter; the voters'
    correlations given the label.  ``start``: labels of the first step; the last
    ``annotators`` voters saw more than the features and share their vote with none."""
    q = np.clip(start.astype(float), 0.02, 0.98)

    def rates() -> np.ndarray:
        return np.stack([((1 - q) @ v + 0.5) / ((1 - q).sum() + 1), (q @ v + 0.5) / (q.sum() + 1)])

    # what is left of the votes when the label explains them; taken once, from the first
    # labels: unsure posteriors would read the label itself as correlation
    fires = rates()
    left = v - (np.outer(1 - q, fires[0]) + np.outer(q, fires[1]))
    cov = left.T @ left / len(v)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    corr = cov / np.outer(sd, sd)
    share = 1 / np.maximum(np.abs(np.where(np.abs(corr) > 0.1, corr, 0)).sum(0), 1)
    share[len(share) - annotators :] = 1
    for _ in range(turns):
        prior = np.clip(q.mean(), 1e-3, 1 - 1e-3)
        fires = rates()
        ratio = v @ (share * (np.log(fires[1]) - np.log(fires[0]))) + (1 - v) @ (share * (np.log1p(-fires[1]) - np.log1p(-fires[0])))
        q = 1 / (1 + np.exp(-np.clip(ratio + np.log(prior / (1 - prior)), -30, 30)))
    return q, fires, corr


def train_linear(x: list[np.ndarray], q: np.ndarray, turns: int = 300, l2: float = 3e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels (full-batch, Adam)."""
    rows = np.repeat(np.arange(len(x)), [len(k) for k in x])
    cols = np.concatenate([*x, np.zeros(0, int)]).astype(int)
    w, b = np.zeros(FEATURES), float(np.log(max(q.mean(), 1e-3) / max(1 - q.mean(), 1e-3)))
    m = s = np.zeros(FEATURES + 1)
    for t in range(1, turns + 1):
        z = np.bincount(rows, weights=w[cols], minlength=len(x)) + b
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - q) / len(x)
        g = np.append(np.bincount(cols, weights=err[rows], minlength=FEATURES) + l2 * w, err.sum())
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - float(step[-1])
    return w, b


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Feature hashes, weights and bias."""
    train = stored(sample(docs, labels), "toxicity-sample")
    kept, odds = strongest(train)
    rows = train.mapInArrow(_rows(kept), "doc_id long, toxic int, x array<int>, w array<boolean>")
    got = rows.orderBy("doc_id").toArrow()  # at most SAMPLE rows of at most FEATURES numbers
    toxic = np.array(got["toxic"].to_pylist(), float)
    if not len(toxic) or toxic.min() == toxic.max():
        p = min(max(float(toxic.mean()) if len(toxic) else 0.0, 1e-9), 1 - 1e-9)
        return kept[:0], np.zeros(0), float(np.log(p / (1 - p)))
    x = [np.array(k, int) for k in got["x"].to_pylist()]
    sets = voters(odds, kept)
    v = np.column_stack([votes(x, np.array(got["w"].to_pylist(), float), sets), toxic])
    q, _, _ = label_model(v, toxic, annotators=1)
    w, b = train_linear(x, q)
    return kept, w[: len(kept)], b


def _score(kept: np.ndarray, w: np.ndarray, b: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = _maybe(kept)
        for batch in batches:
            data, off = as_bytes(batch.column("text"))
            z = np.full(batch.num_rows, b)
            for i, j in slices(off):
                of, k = _match(data[off[i] : off[j]], off[i : j + 1] - off[i], kept, maybe)
                z[i:j] += np.bincount(of, weights=w[k], minlength=j - i) if len(kept) else 0.0
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    return score


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    d = docs.select("doc_id", "text")
    out = d.mapInArrow(_score(*fit(d, labels)), "doc_id long, score double")
    return out.select(
        "doc_id", F.coalesce(crc_mod("doc_id", 4) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

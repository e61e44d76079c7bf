"""Training of the language model over all documents."""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from agora.llm import lm_score
from agora.llm.common import documents


def test_every_document_gives_windows():
    n = np.array([1, 16, 17, 40, 16 * 8 * 5 + 3])
    seq, doc_of = np.arange(n.sum()), np.repeat(np.arange(len(n)), n)
    seen = set()
    for seed in range(lm_score.EVERY):
        x, y, doc = lm_score.windows(seq, n, 9999, np.full(len(n), seed))
        assert set(doc.tolist()) == set(range(len(n)))
        assert (doc_of[y[y >= 0]] == np.repeat(doc, (y >= 0).sum(1))).all()
        seen |= set(y[y >= 0].tolist())
    assert seen == set(seq.tolist())  # the seeds' windows cover all tokens


def test_contexts_are_summed_over_blocks(spark):
    sub = lm_score.Subwords(lm_score.read_ranks())
    size, rng = 2 * sub.size, np.random.default_rng(3)
    blocks = [np.append(rng.integers(0, 300, 200), sub.end) for _ in range(70)]  # more parts than FAN
    hashed = (lm_score.mix64(np.arange(size, dtype=np.uint64)) % np.uint64(lm_score.CONTEXTS)).astype(int)
    want, rows = Counter(), []
    for k, seq in enumerate(blocks):
        for a, b in zip([sub.end, *seq[:-1].tolist()], seq.tolist()):
            want[b, int(hashed[a])] += 1
        pair, times = lm_score.contexts(seq, sub)
        rows.append((k, pair.astype(np.int32).tobytes() + times.astype(np.uint32).tobytes()))
    place = np.full(size, lm_score.FREQUENT, np.int16)
    place[:300] = np.arange(300)
    parts = spark.createDataFrame(rows, "part long, blob binary").repartition(40)
    got = lm_score.summed(parts.mapInArrow(lm_score._frequent_contexts(place), "part long, blob binary"), lm_score.FREQUENT * lm_score.CONTEXTS)
    got = got.reshape(lm_score.FREQUENT, lm_score.CONTEXTS)
    assert got.sum() == sum(c for (b, _), c in want.items() if b < 300)
    assert all(got[b, h] == c for (b, h), c in want.items() if b < 300)


def test_copies_are_averaged_by_their_windows():
    of, place = np.arange(2000) % lm_score.CLASSES, np.arange(2000) % 100
    p = lm_score.first_weights(of, np.ones(2000))
    x, y, _ = lm_score.windows(np.tile(np.arange(10), 100), np.array([1000]), 1999)
    own = np.concatenate([x, y], 1).astype(np.int32)
    t = pa.table({"part": [4, 4], "bucket": [-2, -1], "blob": [own[:20].tobytes(), own[20:].tobytes()]})
    got = lm_score._train_part(p, place, of, 1)((pa.scalar(4),), t)
    flat = lm_score._unpack(got["blob"][0].as_py(), 1 + lm_score._flat(p).size)
    mine = own[1 :: lm_score.ROUNDS]
    span = lm_score.CONTEXT + lm_score.STRIDE
    assert flat[0] == len(mine)
    after = lm_score._flat(lm_score.train(p, mine[:, :span], mine[:, span:], place, of, 1))
    assert np.allclose(flat[1:] / flat[0], after)


def test_held_out_text_scores_above_word_counts(spark):
    r = lm_score.scored(documents(spark, "/root/testdata/sf0.01")).filter("held_out")
    r = r.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert r["score"] > 0.995 * r["base"]  # both are negative


def test_every_token_of_training_documents_is_a_target():
    sub, rng = lm_score.Subwords(lm_score.read_ranks()), np.random.default_rng(5)
    ids = [*range(1, 60), None]
    texts = [None if i == 7 else " ".join(f"w{w}" for w in rng.integers(0, 90, 5 * (i or 0))) for i in ids]
    t = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts})
    rows = lm_score._ask_counts(4, sub)((pa.scalar(2),), t).to_pylist()
    blob = {r["block"]: r["blob"] for r in rows if r["bucket"] < 0}
    used = np.frombuffer(blob[lm_score.TOKENS], np.int64)
    y = lm_score.trained_windows(blob[lm_score.TEXTS], sub.end)[:, lm_score.CONTEXT + lm_score.STRIDE :]
    assert (np.bincount(y[y >= 0], minlength=len(used)) == used).all()
    turns = [lm_score._trains(ids).sum(), used[sub.end]]
    assert turns[0] == turns[1] and len(y) > 8 * turns[0]  # more windows than one of eight


def test_exp_of_far_apart_rows():
    x = np.array([[0, 1, 2], [500, 501, 502], [-900, -901, -902]], np.float32)
    e, top = lm_score._exp(x.copy())
    total = np.log(lm_score._sums(e)) + np.ravel(top)
    assert np.allclose(total, np.log(np.exp(x.astype(float) - x.max(1, keepdims=True)).sum(1)) + x.max(1))


def test_texts_are_not_sent_to_buckets(spark, monkeypatch):
    count = lm_score._count

    def words_only(key, t):
        assert key[0].as_py() >= 0
        return count(key, t)

    monkeypatch.setattr(lm_score, "_count", words_only)
    docs = spark.createDataFrame([(i, f"a b w{i}") for i in range(30)], "doc_id long, text string")
    assert lm_score.scored(docs).count() == 30


def test_rounds_share_out_all_windows():
    sub, rng = lm_score.Subwords(lm_score.read_ranks()), np.random.default_rng(6)
    ids = list(range(1, 80))
    t = pa.table({"doc_id": ids, "text": [" ".join(f"w{w}" for w in rng.integers(0, 90, i % 31)) for i in ids]})
    rows = lm_score._ask_counts(4, sub)((pa.scalar(2),), t).to_pylist()
    blob = next(r["blob"] for r in rows if r["block"] == lm_score.TEXTS)
    w = lm_score.Texts.unpacked(blob)
    seq, n, _, _ = lm_score.token_runs(w, w.tok, w.n, sub.end)
    trains = lm_score._trains(ids)
    x, y, _ = lm_score.windows(seq[np.repeat(trains, n)], n[trains], sub.end)
    whole = np.concatenate([x, y], 1)
    assert (lm_score.trained_windows(blob, sub.end) == whole).all()
    for first in range(lm_score.ROUNDS):
        own, total = lm_score.round_windows(blob, sub.end, first, lm_score.ROUNDS)
        assert total == len(whole) and (own == whole[first :: lm_score.ROUNDS]).all()


def test_attention_and_scores_equal_plain_ones():
    rng = np.random.default_rng(8)
    m = lm_score.Model.__new__(lm_score.Model)
    m.end, m.place, m.of = 1999, np.arange(2000) % 100, rng.integers(0, lm_score.CLASSES, 2000)
    m.within = rng.standard_normal(2000).astype(np.float32)
    n = np.array([1, 16, 17, 40, 300])
    seq = rng.integers(0, 1999, n.sum())
    x, y, _ = lm_score.windows(seq, n, m.end)
    for scale in (1, 60):  # the second makes exp overflow
        m.p = {k: scale * v for k, v in lm_score.first_weights(m.of, np.ones(2000)).items()}
        p = {k: v.astype(float) for k, v in m.p.items()}
        e, want, score = p["E"][m.place[np.maximum(x, 0)]], np.zeros((len(x), lm_score.STRIDE, lm_score.CLASSES)), []
        for i in range(len(x)):
            for r in range(lm_score.STRIDE):
                at = lm_score.CONTEXT + r
                seen = [j for j in range(at + 1) if x[i, j] >= 0]
                a = np.array([e[i, at] @ p["Q"] @ (e[i, j] @ p["K"]) + p["B"][at - j] for j in seen])
                a = np.exp(a - a.max()) / np.exp(a - a.max()).sum()
                want[i, r] = a @ (e[i, seen] @ p["V"]) @ p["O"] + e[i, at] @ p["R"] + p["C"]
                if y[i, r] >= 0:
                    z = want[i, r] - want[i, r].max()
                    score.append(z[m.of[y[i, r]]] - np.log(np.exp(z).sum()) + m.within[y[i, r]])
        live = y >= 0
        got = lm_score.attend(m.p, x, m.place)[0]
        assert np.allclose(got[live], want[live], rtol=1e-3, atol=1e-4 * np.abs(want).max())
        assert np.allclose(m.score(seq, n), score, rtol=1e-3, atol=1e-4 * np.abs(want).max())


def test_distinct_hashes():
    rng = np.random.default_rng(9)
    h = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    for x in (h[rng.integers(0, 500, 4000)], h[rng.integers(0, 500, 4000)] >> np.uint64(55), h[:0], h[:1]):
        for a, b in zip(lm_score.distinct(x), np.unique(x, return_index=True, return_inverse=True)):
            assert (a == b).all()


def test_packed_texts_come_back():
    rng = np.random.default_rng(10)
    for k in (0, 1, 700):
        cols = [rng.integers(0, 1 << 30, m).astype(np.int32) for m in (3 * k, k, k)]
        w = lm_score.Texts([None, 5, -7][: min(k, 3)], np.full(min(k, 3), k), *cols)
        got = lm_score.Texts.unpacked(w.packed())
        assert got.ids == w.ids and all((getattr(got, c) == getattr(w, c)).all() for c in ("n_words", "of", "tok", "n", "doc"))
    w = lm_score.Texts([1], np.array([100000]), rng.zipf(1.3, 100000) % 300000, np.arange(1), np.ones(1, int))
    assert len(w.packed()) < 0.95 * len(pa.compress(w.of.astype(np.int32).tobytes(), codec="zstd", asbytes=True))

"""Each operator against a brute-force version, on edge cases and on the sf0.001 documents."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from agora.llm import (
    byte_dedup, fingerprints, lm_score, mixing, near_dups, passages, pieces, pii, quality, queries, toxicity,
)
from agora.llm.common import documents, rolled, sliding_argmin, table

from . import brute

SF = "/root/testdata/sf0.001"
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "é☃𝒳 x\n"), (6, "word " * 400), (7, "word " * 400), (8, "y" * 3000)]


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in documents(spark, SF).select("doc_id", "text").collect()]


def frame(spark, rows):
    # extra columns, one named like a helper's own
    return spark.createDataFrame([(i, t, 1, "z", None) for i, t in rows], "doc_id long, text string, k int, block string, source string")


def cases(docs):
    return [[], EDGE, docs]


def test_rolling_helpers():
    h = np.random.default_rng(1).integers(0, 1 << 63, 200).astype(np.uint64)
    for n in (1, 5, 35, 200, 201):
        mask, want = (1 << 64) - 1, []
        for i in range(len(h) - n + 1):
            x = 0
            for v in h[i : i + n].tolist():
                x = (x * 0xD6E8FEB86659FD93 + v) & mask
            want.append(x)
        assert rolled(h, n).tolist() == want
    assert sliding_argmin(np.array([3, 1, 1, 2, 0]), 3).tolist() == [1, 1, 4]


def test_fingerprints(spark, docs):
    for rows in cases(docs):
        got = {r.doc_id: r for r in fingerprints.report(frame(spark, rows)).collect()}
        want = brute.edited(rows)
        assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == {i: w[:2] for i, w in want.items()}
        for i, t in rows:
            assert got[i].fingerprint == fingerprints.fingerprint(t)
            assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.9
    a = fingerprints.fingerprint("x y z w\nq")
    assert a == fingerprints.fingerprint("q\nx y z w") != fingerprints.fingerprint("x y z w q")
    assert fingerprints.minus(a, fingerprints.fingerprint("q")) == fingerprints.fingerprint("x y z w")
    assert fingerprints.plus(fingerprints.fingerprint("q"), fingerprints.fingerprint("x y z w")) == a


def test_fingerprints_ties(spark):
    rows = [(None, "n"), (3, "b"), (3, "a"), (3, "a")]
    got = fingerprints.report(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 1), (3, 1), (3, 1), (3, 1)]


def test_toxicity(spark):
    rng, rows, labels = random.Random(2), [], []
    plain = [f"w{i}" for i in range(300)]
    for i in range(900):
        toxic = i % 5 == 0
        text = rng.choices([f"{chr(97 + int(w[1:]) % 26)}{chr(97 + int(w[1:]) // 26)}ord" for w in plain], k=60)
        if toxic:
            text[rng.randrange(60)] = rng.choice(["scoundrel,", "VILLAIN", "knave."])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(frame(spark, [*rows, (1000, None)]), lab).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in set(held)) for i in range(900))
    assert np.mean([got[i].predicted == int(i % 5 == 0) for i in held]) > 0.97
    assert 0 <= got[1000].score < 0.3
    none = toxicity.scored(frame(spark, EDGE), lab.filter("false")).collect()
    assert len(none) == len(EDGE) and all(r.predicted == 0 for r in none)


def test_label_model_shares_the_vote_of_copies():
    g = np.random.default_rng(3)
    y = g.random(4000) < 0.3
    vote = lambda hit: (np.where(y, g.random(4000) < hit, g.random(4000) < 0.1)).astype(float)
    weak = vote(0.5)
    v = np.column_stack([vote(0.9), vote(0.8), *[weak] * 6])
    q, fires, corr = toxicity.label_model(v, v[:, 0])
    assert corr[2, 3] > 0.9 and abs(fires[1, 0] - 0.9) < 0.1
    assert ((q > 0.5) == y).mean() > 0.88


def test_passages(spark, docs):
    rng = random.Random(1)
    base = [str(rng.randrange(50)) for _ in range(400)]
    cut = lambda a, b: " ".join(base[a:b])
    own = [(None, "x"), (3, cut(0, 60)), (4, cut(20, 90) + "\t\n"), (5, cut(300, 400)), (5, cut(300, 400)), (9, cut(0, 35)), (10, cut(300, 334))]
    for rows in [*cases(docs), own]:
        got = passages.removed(frame(spark, rows)).collect()
        order = lambda r: tuple(str(x) for x in r)
        assert sorted(map(tuple, got), key=order) == sorted(brute.passages(rows), key=order)


def test_passages_heavy_anchors(spark, docs, monkeypatch):
    monkeypatch.setattr(passages, "HEAVY", 2)
    got = passages.removed(frame(spark, docs), block_bytes=20_000).collect()
    assert sorted(map(tuple, got)) == sorted(brute.passages(docs))


def test_quality_rules(spark, docs):
    lab = table(spark, SF, "labels")
    for rows in cases(docs):
        got = {r.doc_id: r for r in quality.judged(frame(spark, rows).select("doc_id", "text"), lab).collect()}
        assert len(got) == len(rows)
        for i, t in rows:
            r, (want, failed) = got[i], brute.rules(t)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == failed and not (failed and r.kept)
    kept = quality.kept_documents(frame(spark, docs), lab)
    assert kept.columns == frame(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.kept)
    bare = quality.judged(frame(spark, docs).select("doc_id", "text"), lab.filter("false")).collect()
    assert all(r.kept != r.base_failed for r in bare)


def test_quality_rules_learn_from_every_trusted_document(spark):
    # 21,000 labelled rows whose words differ: none may be missing from the counts
    n = 21_000
    d = spark.range(n).selectExpr("id AS doc_id", "concat('w', id % 7, ' v', id % 11) AS text")
    lab = d.selectExpr("doc_id", "1 AS quality").union(d.limit(5).selectExpr("doc_id", "1 AS quality"))
    # every document is trusted, so counts equal what is expected and no n-gram has weight
    got = quality.judged(d, lab).groupBy("ratio").count().collect()
    assert [(r.ratio, r["count"]) for r in got] == [(0.0, n)]


def test_quality_quantile_is_exact(spark):
    g = np.random.default_rng(5)
    for x in (g.normal(0, 1, 3000).round(5), [0.25], [-1.0] * 50 + [2.0], [0.1, 0.1 + 1e-9, 3.0], [-0.5, 0.5]):
        ratios = spark.createDataFrame([(float(v),) for v in x], "ratio double")
        for part in (0.0, 0.005, 0.5, 0.987, 1.0):
            assert quality.quantile(ratios, part) == pytest.approx(float(np.quantile(x, part)), abs=1e-12)
    assert quality.quantile(spark.createDataFrame([], "ratio double"), 0.005) == 0.0


def test_near_duplicates(spark, docs, monkeypatch):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    line, rows, k = " ".join(rng.choices(vocab, k=12)), [*EDGE, (20, "a b c d e f g"), (21, "A b c d e f g h"), (22, "b a")], 30
    for _ in range(8):
        base = rng.choices(vocab, k=rng.choice([8, 12, 20, 40, 60, 90, 300]))
        for _ in range(20):
            b = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                b[rng.randrange(len(b))] = rng.choice(vocab)
            rows.append((k, (line + " " if rng.random() < 0.3 else "") + " ".join(b)))
            k += 1
    chain = rng.choices(vocab, k=150)
    for _ in range(40):
        for _ in range(3):
            chain[rng.randrange(150)] = rng.choice(vocab)
        rows.append((k, " ".join(chain)))
        k += 1
    monkeypatch.setattr(near_dups, "CHUNK", 16)
    monkeypatch.setattr(near_dups, "LIGHT", 4)
    for case in ([], rows, docs):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dups.near_duplicates(frame(spark, case)).collect()}
        assert got == brute.near(case)


def test_near_duplicates_repeated_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (None, "q")]
    got = sorted(((r.doc_id or 0), r.component_id or 0, r.kept) for r in near_dups.near_duplicates(frame(spark, rows)).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]


def test_personal_data(spark, docs):
    odd = [
        "a@b.c_d@e.f", "a@b.cx@d.e.f", "x..@a.b", "1.2.3.4.5.6.7.8", "999.1.2.3 1.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111-2",
        "é+1 (555) 123-4567) +1", "+1+12345678", "1 " * 50 + "4" * 16, "☃4111111111111111 a@b.co", "0.0.0.256 00000001.2.3.255",
        "..1.2.3.4a.b@c.d", "1" * 20000, "a" * 20000 + "@b.c", "1 " * 20000, "a.b@c.d.e" * 30,
    ]
    for rows in [*cases(docs), list(enumerate(odd))]:
        got = {r.doc_id: r for r in pii.report(pii.find(frame(spark, rows))).collect()}
        for i, t in rows:
            want, r = brute.spans(t), got[i]
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(x) for x in want]
            assert r.base_sha256 == brute.sha(",".join(sum(want, [])))
            assert set(sum(want, [])) <= set(r.spans.split(",")) | {""}


def test_personal_data_bootstraps_unseen_values(spark):
    key = lambda k: f"{k}f3ef4d6b2755a36d7d9c25bd72c4d5f67e"
    rows = [(k, f'lead é text apikey = "{key(k)}" more') for k in range(8)]
    rows += [(20, 'new apikey = "ab12cd9" here'), (21, 'other word: "ab12cd9" no')]
    got = {r.doc_id: r.spans for r in pii.report(pii.find(frame(spark, rows))).collect()}
    assert got[20] == "secret:14:21" and got[21] == "" and got[0] == f"secret:22:{22 + len(key(0))}"
    masked = {r.doc_id: r.text for r in pii.masked(frame(spark, rows)).collect()}
    assert masked[20] == 'new apikey = "<secret>" here' and masked[21] == rows[-1][1]


def test_personal_data_long_values_and_cues(spark):
    key = lambda k: f"{k}f3ef4d6b2755a36d7d9c25bd72c4d5f67e"
    cue, token = "internal_service_gateway_access_token_of_the_team", "ey0.aB-_9/" * 40 + "Zz1"
    rows = [(k, f"x {cue}={key(k)} y") for k in range(8)] + [(20, f"x {cue}={token}.. y")]
    masked = {r.doc_id: r.text for r in pii.masked(frame(spark, rows)).collect()}
    assert masked == {**{k: f"x {cue}=<secret> y" for k in range(8)}, 20: f"x {cue}=<secret>.. y"}


def test_personal_data_numbers_after_a_phone_cue(spark):
    rows = [(k, f"phone: +1 (55{k}) 123-4567 or") for k in range(8)]
    rows += [(20, "phone: (020) 7946 0958."), (21, "Phone: 02079460958 x"), (22, "other: 020 7946 0958")]
    rows += [(30 + k, f"host: 10.0.0.{k} 8080") for k in range(8)] + [(40, "host: node-17a 12345678")]
    masked = {r.doc_id: r.text for r in pii.masked(frame(spark, rows)).collect()}
    assert [masked[k] for k in (0, 20, 21, 22)] == ["phone: <phone> or", "phone: <phone>.", "Phone: <phone> x", rows[10][1]]
    assert masked[31] == "host: <ip> 8080" and masked[40] == "host: <ip> 12345678"


def test_lm_scores(spark, docs):
    for rows in cases(docs):
        got = {r.doc_id: r for r in lm_score.scored(frame(spark, rows)).collect()}
        for i, (n, known, total, base) in brute.unigram(rows).items():
            r = got[i]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
            assert r.base_score == pytest.approx(base, rel=1e-9) and r.score <= 1e-6
            assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
    assert np.corrcoef([r.score for r in got.values()], [r.base_score for r in got.values()])[0, 1] > 0.9


def test_lm_windows_score_each_token_once():
    n = np.array([1, 16, 17, 40])
    seq = np.arange(n.sum())
    x, y, doc = lm_score.windows(seq, n, 999)
    assert sorted(y[y >= 0].tolist()) == seq.tolist()
    assert (x[:, lm_score.CONTEXT :] >= 0).sum() == len(seq) and x[0, lm_score.CONTEXT] == 999
    assert np.bincount(doc).tolist() == [1, 1, 2, 3]


def test_lm_attention_is_causal_and_its_gradient_learns():
    g = np.random.default_rng(5)
    seq = np.tile(np.arange(10), 300)
    place, of = np.arange(2000) % 100, (np.arange(2000) % lm_score.CLASSES)
    x, y, _ = lm_score.windows(seq, np.array([3000]), 1999)
    first = lm_score.first_weights(of, np.bincount(seq, minlength=2000))
    p = lm_score.train(first, x, y, place, of, 0)
    z, _ = lm_score.attend(p, x, place)
    assert (z.argmax(2) == of[np.maximum(y, 0)])[y >= 0].mean() > 0.95
    later = x.copy()
    later[:, -1] = g.integers(0, 10, len(x))
    assert np.allclose(lm_score.attend(p, later, place)[0][:, :-1], z[:, :-1])


def test_repeated_bytes(spark, docs, monkeypatch):
    rng = random.Random(1)
    base = "".join(chr(97 + rng.randrange(3)) for _ in range(900))
    own = [(None, "x"), (3, base[:300]), (4, base[100:420]), (5, "a" * 500), (6, "a" * 120), (7, base[600:699]), (8, base[600:900]),
           (8, base[600:900]), (9, base[:100]), (-5, base[50:160] + "Q" + base[55:170])]
    order = lambda r: tuple(str(x) for x in r)
    for rows in [*cases(docs), own]:
        got = byte_dedup.removed(frame(spark, rows)).collect()
        assert sorted(map(tuple, got), key=order) == sorted(brute.byte_spans(rows), key=order)
    monkeypatch.setattr(byte_dedup, "HEAVY", 2)
    monkeypatch.setattr(byte_dedup, "PIECE", 1000)
    got = byte_dedup.removed(frame(spark, docs), block_bytes=20_000).collect()
    assert sorted(map(tuple, got)) == sorted(brute.byte_spans(docs))


def test_source_mix(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([1, 5, 50, 300]), rng.choice(["b", "a", "C", None, "é"])) for i in range(1500)]
    rows += [(5000, None, "a"), (5001, "", "zero"), (1, "w", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    again = mixing.mix(df.repartition(7)).collect()
    key = lambda r: (r.doc_id, r.source or "~", r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(brute.words(t))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    want, capped = {}, set()
    while True:
        rest = sum(size.values()) - sum(3 * size[s] for s in capped)
        share = sum(weight[s] for s in order if s not in capped)
        want = {s: 3.0 * size[s] if s in capped else rest * weight[s] / share for s in order}
        over = {s for s in order if s not in capped and want[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    for s in order:
        own = [r for r in got if r.source == s]
        assert own[0].target == pytest.approx(want[s]) and own[0].source_size == size[s]
        assert all(r.taken <= 3 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= max(25, 0.005 * want[s])
    copies = {}
    for r in mixing.mix_documents(df).collect():
        copies[(r.doc_id, r.source)] = copies.get((r.doc_id, r.source), 0) + 1
    assert sum(r.copies for r in got) == sum(copies.values())
    assert mixing.mix(df.filter("false")).count() == 0


def test_flight_keeps_both_sums():
    rng = random.Random(6)
    size, p = [rng.randrange(1, 500) for _ in range(200)], [rng.random() * 0.9 + 0.05 for _ in range(200)]
    q = mixing.flight(size, p, rng, list(range(200)))
    assert sum(0 < x < 1 for x in q) <= 2
    assert sum(q) == pytest.approx(sum(p)) and sum(a * b for a, b in zip(size, q)) == pytest.approx(sum(a * b for a, b in zip(size, p)))


def test_pieces(spark, docs):
    import sentencepiece

    tables = pieces.load()
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [t or "" for _, t in docs + EDGE] + ["a  b", " lead", "trail ", "a\nb\tc", "▁x a▁b", "\x00\x01", "ｆｕｌｌ", "  ", "the " * 300]
    zero = np.zeros(len(texts), np.uint64)
    split = lambda got: [x.tolist() for x in np.split(got[0], np.cumsum(got[1])[:-1])]
    plain = split(pieces.Encoder(tables, 0.0).encode(texts, zero))
    assert all(a == b for a, b, t in zip(plain, sp.encode(texts), texts) if "▁" not in t)
    for seed in (10, 11):
        got = pieces.Encoder(tables, 0.2, seed).encode(texts, zero)
        assert [b.decode() for b in pieces.decode(*got, tables)] == texts
        assert split(got) != plain
    assert split(pieces.Encoder(tables, 0.2, 10).encode(texts, zero)) != split(got)
    some = texts[:40]
    whole = split(pieces.Encoder(tables, 0.1).encode(some, zero[:40]))
    old, pieces.LONG = pieces.LONG, 3
    try:
        assert split(pieces.Encoder(tables, 0.1).encode(some, zero[:40])) == whole
    finally:
        pieces.LONG = old
    for rows in cases(docs):
        got = pieces.round_trip(frame(spark, rows)).collect()
        assert len(got) == len(rows) and all(r.lossless for r in got)


def test_pieces_vary_by_occurrence_document_and_copy(spark):
    text = " ".join(["international"] * 300)
    rows = [(i, text, c) for i in range(6) for c in (1, 2)]
    d = spark.createDataFrame(rows, "doc_id long, text string, copy int")
    tables = pieces.load()
    got = {(r.doc_id, r.copy): r.ids for r in pieces.encoded(d, tables, copy="copy").collect()}
    assert len({tuple(x) for x in got.values()}) == len(rows)
    assert got == {(r.doc_id, r.copy): r.ids for r in pieces.encoded(d.repartition(5), tables, copy="copy").collect()}
    cuts = {tuple(x) for ids in got.values() for x in np.split(ids, [k for k in range(1, len(ids)) if tables.text[tables.at[ids[k]]] == 32])}
    assert len(cuts) > 4


def test_pieces_equal_the_heap_of_each_occurrence(monkeypatch):
    tables, texts = pieces.load(), ["the " * 50 + "understanding of the understanding"] * 2
    key = np.array([1, 2], np.uint64)
    ids, n = pieces.Encoder(tables, 0.3).encode(texts, key)
    monkeypatch.setattr(pieces, "LONG", 0)  # no sharing: every occurrence through the heap
    want, m = pieces.Encoder(tables, 0.3).encode(texts, key)
    assert ids.tolist() == want.tolist() and n.tolist() == m.tolist()


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert out.columns == ["doc_id", "source", "ids", "n_ids", "lossless"] and all(r.lossless for r in rows)
    d = documents(spark, SF)
    kept = quality.kept_documents(d, table(spark, SF, "labels"))
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    one = {i for i, v in brute.near(texts).items() if v[2]}
    assert {r.doc_id for r in rows} <= one and len(rows) > 0


def test_registered_names():
    assert sorted(int(k.split("_")[0][2:]) for k in queries.QUERIES) == list(range(1, 14))


CLASHING = "doc_id long, text string, source string, lang string, email string, added string, n_words int, kept string, ratio int, copy string, copies int, __text string, block int"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "s", "en", "mine", "mine", 99, "mine", 99, "mine", 99, "mine", 99) for i, t in rows], CLASHING)


def test_columns_of_any_name_stay(spark):
    words = " ".join(f"word{i}" for i in range(30))
    rows = [(1, f"{words} mail me at a@b.org"), (2, words), (None, None), (3, "few words")]
    df = clashing(spark, rows)
    labels = spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int")
    got = pii.masked(df)
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: f"{words} mail me at <email>", 2: words, None: None, 3: "few words"}
    kept = quality.kept_documents(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {2} and 3 not in {r.doc_id for r in kept.collect()}
    mixed = mixing.mix_documents(df)
    assert mixed.columns == [*df.columns, "copy_"]
    for out in (got, kept, mixed):
        assert {(r.email, r.added, r.n_words, r.kept, r.ratio, r.copy, r.copies, r["__text"], r.block) for r in out.collect()} == {
            ("mine", "mine", 99, "mine", 99, "mine", 99, "mine", 99)
        }
    assert near_dups.kept_documents(df).columns == df.columns


def brute_components(rows):
    def shingles(text):
        w = brute.words(brute.lower(text))
        return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("chunk", [24, 1024])
def test_near_duplicates_in_one_large_group(spark, monkeypatch, chunk):
    """Copies of one base that are not all alike, beside texts that share a passage."""
    monkeypatch.setattr(near_dups, "CHUNK", chunk)
    monkeypatch.setattr(near_dups, "LIGHT", 4)
    monkeypatch.setattr(near_dups, "TYPICAL", 3)
    monkeypatch.setattr(near_dups, "FEW", 2)
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    base, passage, texts = rng.choices(words, k=120), rng.choices(words, k=50), []
    for _ in range(150):
        t = list(base)
        for _ in range(rng.randrange(1, 5)):
            t[rng.randrange(120)] = rng.choice(words)
        texts.append(t)
    for _ in range(80):
        texts.append(rng.choices(words, k=rng.randrange(20, 80)) + passage + rng.choices(words, k=rng.randrange(5, 40)))
    texts += [rng.choices(words, k=rng.randrange(1, 60)) for _ in range(40)]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in near_dups.near_duplicates(frame(spark, rows)).collect()}
    want = brute_components(rows)
    assert got == want and 1 < len(set(want.values())) < len(rows)


def test_pieces_of_long_letters(spark):
    """A long run of letters takes the same ids through plain numbers as through arrays."""
    tables = pieces.load()
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdefgh", k=n)) for n in (63, 64, 65, 200, 3000)]
    for dropout in (0.0, 0.1, 0.9):
        enc = pieces.Encoder(tables, dropout)
        variant = np.arange(len(texts), dtype=np.uint64)
        ids, n = enc.encode(texts, variant)
        edge = np.cumsum(n) - n
        for k, t in enumerate(texts):
            sym = enc.char[np.frombuffer((" " + t).encode("utf-32-le"), np.uint32)]
            salt = None if not dropout else pieces.mix64(pieces.mix64(enc.key ^ pieces.mix64(variant[k : k + 1])) ^ np.uint64(0))
            together, count = enc._together(sym.copy(), np.array([len(sym)]), salt)
            assert ids[edge[k] : edge[k] + n[k]].tolist() == together.tolist() and count[0] == n[k]


def test_near_pairs_are_packed_by_document():
    """A chunk of near copies that are no links gives rows by document, not by pair."""
    rng = np.random.default_rng(4)
    base, n = np.sort(rng.integers(0, 1 << 62, 400)).astype(np.uint64), 60
    # two of them share 7/10 of their union or less: over the estimate's margin, under a link
    sets = [np.sort(np.concatenate([rng.choice(base, 340, replace=False), rng.integers(0, 1 << 62, 20).astype(np.uint64)])) for _ in range(n)]
    sets[7] = sets[3].copy()
    sets[7][-1] += np.uint64(1)
    t = pa.table({
        "doc_id": pa.array(range(n), pa.int64()), "root": pa.array(range(n), pa.int64()), "side": pa.array([0] * n, pa.int64()),
        "n_shingles": pa.array([len(x) for x in sets], pa.int64()), "sketch": [x[: near_dups.K].tobytes() for x in sets],
        "keys": pa.array([[5]] * n, pa.list_(pa.int64())),
    })
    key = (pa.scalar(5), pa.scalar(0), pa.scalar(0))
    met = near_dups._compare(key, t)
    assert met.num_rows <= n
    open_ = {(a, int(b)) for a, o in zip(met["doc_id"].to_pylist(), met["open"].to_pylist()) for b in np.frombuffer(o or b"", np.int64)}
    likely = {
        (a, b) for a in range(n) for b in range(a + 1, n)
        if near_dups._estimate(sets[a][: near_dups.K], len(sets[a]), sets[b][: near_dups.K], len(sets[b])) >= near_dups.PERCENT / 100 - near_dups.MARGIN
    }
    assert {(min(x), max(x)) for x in open_} == likely and len(likely) > 5 * n
    whole = met.append_column("whole", [[sets[i].tobytes() for i in met["doc_id"].to_pylist()]])
    linked = near_dups._confirm_chunk(key, whole).to_pylist()
    want = {
        (a, b) for a, b in likely
        if 100 * (both := len(np.intersect1d(sets[a], sets[b]))) >= near_dups.PERCENT * (len(sets[a]) + len(sets[b]) - both)
    }
    assert (3, 7) in want and {(r["a"], r["b"]) for r in linked} <= want
    up = {i: i for i in range(n)}
    ends = np.array(sorted(want))
    assert len(near_dups._forest(up, ends[:, 0], ends[:, 1], ends[:, 0], ends[:, 1])) == len(linked)


def test_open_pairs_of_documents_with_several_sets(monkeypatch):
    a, b = np.arange(300, dtype=np.uint64), np.arange(1000, 1300, dtype=np.uint64)
    ids = lambda *x: np.array(x, np.int64).tobytes()
    # document 1 has two sets, one of them in two rows; 2 is linked by the second, 4 by none
    rows = [(1, ids(2, 4), a), (1, ids(2, 4), a), (1, ids(4), b), (2, ids(3), b[:280]), (3, ids(), b[:270]), (4, ids(), a[:200])]
    t = pa.table({"doc_id": [i for i, _, _ in rows], "open": [o for _, o, _ in rows], "whole": [x.tobytes() for _, _, x in rows]})
    for most in (near_dups.MOST_VALUES, 500):
        monkeypatch.setattr(near_dups, "MOST_VALUES", most)
        got = near_dups._confirm_chunk((), t).to_pylist()
        assert sorted((r["a"], r["b"]) for r in got) == [(1, 2), (2, 3)]

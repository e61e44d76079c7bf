"""Operators 11 to 13: term divergence, token counts and periodic runs."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from agora.llm import divergence, periods, queries, token_count
from agora.llm.common import documents

from . import brute
from .test_operators import EDGE, SF, frame


# ---------- periodic runs

def runs_of(w):
    """Every maximal stretch with its smallest period, by trying all periods."""
    out = []
    for p in range(1, len(w) // 4 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            n = j + p - i
            if j > i and n >= max(6, 4 * p):
                if not any(all(w[x] == w[x + q] for x in range(i, i + n - q)) for q in range(1, p)):
                    out.append((i, n, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(words, i):
    h = zlib.crc32(str(i).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]


def runs_row(i, text):
    w = planted(brute.words(text), i)
    runs = runs_of(w)
    gone = {x for s, n, p in runs for x in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    return (
        len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
        brute.sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)),
        brute.sha(" ".join(x for k, x in enumerate(w) if k not in gone)),
    )


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(400):
        docs = []
        for _ in range(rng.randrange(1, 6)):
            k = rng.randrange(1, 5)
            w = [str(rng.randrange(k)).encode() for _ in range(rng.randrange(70))]
            if w and rng.random() < 0.7:
                a = rng.randrange(len(w))
                p = 1 + (len(w) - a) // rng.randrange(3, 11)
                w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
            docs.append(w)
        assert periods.found(docs) == [runs_of(w) for w in docs]


def test_range_successor():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 64, 200):
        values = rng.permutation(n)
        lo = rng.integers(0, n + 1, 300)
        hi = np.maximum(lo, rng.integers(0, n + 1, 300))
        x = rng.integers(0, n, 300)
        want = [min((v for v in values[a:b].tolist() if v > y), default=-1) for a, b, y in zip(lo, hi, x)]
        assert periods.RangeSuccessor(values).after(lo, hi, x).tolist() == want


def test_runs_of_one_long_text():
    words = [b"a", b"b", b"c"] * 20_000 + [b"x"] + [b"y", b"y"] * 9 + [str(i).encode() for i in range(5000)] * 5
    assert periods.found([words]) == [[(0, 60_000, 3), (60_001, 18, 1), (60_019, 25_000, 5000)]]
    assert len(periods.collapsed(words, periods.found([words])[0]).split()) == 3 + 1 + 1 + 5000


def test_runs_query(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    for case in ([], EDGE + [(9, "a b " * 5 + "c"), (9, "x " * 6), (9, "x " * 6), (10, "x " * 5)], rows):
        got = sorted(tuple(r) for r in periods.report(frame(spark, case)).collect())
        assert got == sorted((i, *runs_row(i, t)) for i, t in case)
    assert sum(r[1] for r in got) > 10
    null = periods.report(frame(spark, [(None, "q " * 7)])).collect()[0]
    assert (null.doc_id, null.n_runs, null.length) == (None, 1, 7)


# ---------- token counts

@pytest.fixture(scope="module")
def tokens():
    return token_count.Tokens(token_count.load())


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def counted(tokens, texts):
    raw = [t.encode() for t in texts]
    return tokens.count(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])).tolist()


PIECES = [
    "a", "b", "e", "s", "t", "l", "r", "v", "m", "d", "'", " ", "  ", "\n", "\t", "\r\n", "1", "23", "!", "<", "|", ">",
    "<|endoftext|>", "<|endof", "text|>", "é", "ß", "中", "😀", "\xa0", " ", "\x85", "​", "the", " the", "==",
    "-----", "Ᲊ", "Ɤ", "՘", "don't", "they're", "I'll", "''s", "N’", "\x00", "\x1c",
]


def test_counts_of_random_pieces(tokens, library):
    rng = random.Random(3)
    for _ in range(60):
        texts = ["".join(rng.choices(PIECES, k=rng.randrange(60))) for _ in range(40)]
        assert counted(tokens, texts) == library(texts)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(97, 123), rng.randrange(0xD800)])) for _ in range(300)) for _ in range(100)]
    assert counted(tokens, texts) == library(texts)


def test_counts_of_long_words(tokens, library):
    rng = random.Random(4)
    texts = [
        "=" * 5000, "a" * 3000, "".join(rng.choices("abcdefghijklmnop", k=20_000)), "中文" * 1000, " " * 3000 + "x", "\n" * 777,
        "aé" * 999, "".join(rng.choices("ab", k=20_000)), "x" * token_count.LONG + "y",
    ]
    assert counted(tokens, texts) == library(texts)


def test_counter_starts_anew(tokens, library, monkeypatch):
    monkeypatch.setattr(token_count, "MAX_STATES", 10)
    texts = ["some words of a text", "and 1234 others, don't you know"]
    for t in texts * 2:
        assert counted(tokens, [t]) == library([t])
        assert len(tokens.counter.states) < 200


def test_prefix_scan():
    maps = np.random.default_rng(5).integers(0, 8, (37, 8)).astype(np.uint8)
    state, want = np.arange(8), []
    for m in maps:
        state = m[state]
        want.append(state)
    assert (token_count.composed(maps) == np.array(want)).all()


def test_token_count_query(spark, library):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    for case in ([], [*EDGE, (None, "x y"), (3, "<|endoftext|> a"), (3, "b " * 600)], rows):
        got = sorted(tuple(r) for r in token_count.counted(frame(spark, case).withColumnRenamed("k", "n_tokens")).collect() if r.doc_id is not None)
        n = library([t or "" for _, t in case])
        assert got == sorted((i, len((t or "").encode()), k, k > 512) for (i, t), k in zip(case, n) if i is not None)


# ---------- divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audited(rows, top=200):
    """rows: (text, lang, source)."""
    found, docs, groups = Counter(), defaultdict(set), set()
    for k, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for t in map(brute.lower, TERM.findall(text or "")):
            found[lang, source, t] += 1
            docs[lang, t].add(k)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (la, t), d in docs.items() if la == lang and len(d) >= 3)
        own = sorted(s for la, s in groups if la == lang)

        def shares(count):
            total = sum(count) + len(kept)
            return [1 + 1_000_000_000 * (c + 1) // total for c in count]

        n = {s: [found[lang, s, t] for t in kept] for s in own}
        p = {s: shares(n[s]) for s in own}
        q = shares([sum(n[s][k] for s in own) for k in range(len(kept))])
        f = lambda a, b: (a - b) ** 2 // b
        for s in own:
            pair = sorted((-sum(map(f, p[s], p[o])), o.encode()) for o in own if o != s)
            term = sorted((-f(a, b), t.encode()) for t, c, a, b in zip(kept, n[s], p[s], q) if c and a > b)[:top]
            for part, items in (("pair", pair), ("term", term)):
                out += [(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(items, 1)]
    return sorted(out)


def texts(spark, rows):
    schema = "text string, lang string, source string, doc_id string, n string, term string, p int"
    return spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], schema)


def test_divergence(spark):
    rng = random.Random(6)
    vocabulary = ["Ab", "ab", "é", "naïve", "x" * 64, "x" * 65, "x" * 200, "x" * 199 + "y", "straße", "z9z", "qq"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [
        (" ".join(rng.choices(vocabulary, k=rng.randrange(30))), rng.choice(["en", "de", None, ""]), rng.choice([f"s{i}" for i in range(5)] + [None]))
        for _ in range(300)
    ]
    rows += [(None, "en", "silent"), ("", "xx", "a"), ("once", "xx", "b"), (None, "yy", None), rows[0], rows[0]]
    got = sorted(tuple(r) for r in divergence.audit(texts(spark, rows)).collect())
    assert got == audited(rows)
    assert sorted(tuple(r) for r in divergence.audit(texts(spark, rows), top=2, max_groups=1).collect()) == audited(rows, 2)
    assert divergence.audit(texts(spark, [])).collect() == []
    silent = [(None, "en", "a"), ("x", "en", "b")]
    assert sorted(tuple(r) for r in divergence.audit(texts(spark, silent)).collect()) == audited(silent)


def test_pointer_sort():
    rng = random.Random(7)
    words = [rng.choice(["a", "aa", "b" * 8, "b" * 9, "c" * 64, "c" * 65, "c" * 64 + "d", "c" * 300, "é"]).encode() for _ in range(500)]
    size = np.array([len(w) for w in words])
    data = np.frombuffer(b" ".join(words), np.uint8)
    start = np.cumsum(size + 1) - size - 1
    shard = np.array([rng.randrange(3) for _ in words])
    order, run = divergence.pointer_sort(data, start, size, shard)
    keys = [(shard[i], words[i]) for i in order]
    assert keys == sorted(keys)
    assert len(set(zip(run.tolist(), keys))) == len(set(keys)) == run[-1] + 1
    for k in set(keys):
        mine = [i for i, x in zip(order.tolist(), keys) if x == k]
        assert mine == sorted(mine)


def test_slice_counts_do_not_join_texts():
    text = pa.array(["ab", "cd", None, "cd"])
    from agora.llm.common import as_bytes

    data, off = as_bytes(text)
    got = divergence.slice_counts(data, off, pa.array(["l"] * 4), pa.array(["s"] * 4)).to_pylist()
    assert [(r["term"], r["n"], r["docs"]) for r in got] == [("ab", 1, 1), ("cd", 2, 2)]


def test_divergence_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = queries.QUERIES["op11_source_divergence"](spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE['op11_source_divergence']})").fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(want)


def test_round_trip_runs_in_one_python_worker_a_task(spark):
    from agora.llm import pieces

    rows = [(1, "a  b▁ ünd 日本", "s"), (2, None, None), (3, "", "t"), (None, "x" * 90, "s")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = pieces.round_trip(d, keep=["source"])
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    tables = pieces.load()
    want = pieces.decoded(pieces.encoded(d, tables), tables).collect()
    key = lambda r: str(r["doc_id"])
    for a, b in zip(sorted(got.collect(), key=key), sorted(want, key=key)):
        assert (a["doc_id"], a["source"], a["ids"]) == (b["doc_id"], b["source"], b["ids"])
        assert a["lossless"] and b["text"] == b["decoded"] and a["n_ids"] == max(0, len(b["ids"] or []))

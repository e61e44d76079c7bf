"""How far the sources of a language diverge in their terms, and by which terms.

A term is a run of letters A-Z, a-z and characters from U+0080 on, A-Z lower-cased; a
language keeps the terms in at least MIN_DOCS of its documents.  Every (lang, source)
group gives a kept term p = 1 + floor(SCALE * (count + 1) / (N + V)), N being the count
of all kept terms in the group and V their number in the language; the language does the
same with its own counts.  A term's divergence is floor((p - q)^2 / q).

Token-start pointer sort, in tasks: the starts of all terms of a slice are pointers into
the text's Arrow buffer.  A multikey quicksort orders them by language (the shard) and
then by eight bytes at a time, each round only within runs that are still equal; terms
that are equal in their first DEEP bytes and longer are told apart by their rest at
once.  A run of equal terms gives, by source, occurrences and documents.  Only these
counts are shuffled: summed by (lang, source, term), then gathered by (lang, term),
one entry for each source of the language.

Part ``term`` ranks each group's terms over the language's own p, TOP at most (a report).
Part ``pair`` sums the divergence of each ordered pair of sources over all kept terms:
tasks hold one square of sources for each language and emit its sums.  For that they
get the list of groups, whose square the result has anyway, while it has MAX_GROUPS rows
at most; beyond that, ``pair_sums_joined`` does the same by joins.

All arithmetic is on integers.  Null text, lang and source are ''.  Groups without terms
take part with p of count 0, or with value 0 where the language keeps none.  Rows with
equal ids are separate documents; doc_id and other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.llm.common import as_bytes, lower, slices, stored, word_spans

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
SLICE = 4 << 20
DEEP = 64  # bytes that the sort compares eight at a time
MAX_GROUPS = 20_000
CELLS = 1 << 18  # of a task's term by source table

_APART = np.ones(256, dtype=bool)
_APART[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _eight(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next eight bytes as a number that sorts as they do; 0 past a term's end."""
    key = np.zeros(len(at), np.uint64)
    for k in range(8):
        inside = left > k
        byte = np.where(inside, data[np.minimum(at + k, len(data) - 1)], 0)
        key = key << np.uint64(8) | byte.astype(np.uint64)
    return key


def _changes(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def pointer_sort(data: np.ndarray, start: np.ndarray, size: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pointers in order of shard and term, and the number of each one's run.

    Stable: pointers to equal terms of a shard stay in their order.
    """
    order = np.lexsort((_eight(data, start, size), shard))
    key = _eight(data, start[order], size[order])
    new = _changes(shard[order], key)
    for depth in range(8, DEEP, 8):
        run = np.cumsum(new)
        more = np.bincount(run, size[order] > depth)[run] > 0  # runs with a longer term
        more &= np.bincount(run)[run] > 1
        open_ = np.flatnonzero(more)
        if not len(open_):
            break
        i = order[open_]
        key = _eight(data, start[i] + depth, size[i] - depth)
        again = np.lexsort((key, run[open_]))
        order[open_] = i[again]
        new[open_] |= _changes(run[open_], key[again])
    run = np.cumsum(new)
    if len(size) and int(size.max()) > DEEP:
        # within a run the terms that end at DEEP come first, then the longer ones by their rest
        long = size[order] > DEEP
        by = np.lexsort((long, run))
        order, run, long = order[by], run[by], long[by]
        new = _changes(run, long)
        at = np.flatnonzero(long)
        rest = [data[a : a + n].tobytes() for a, n in zip(start[order[at]] + DEEP, size[order[at]] - DEEP)]
        by = sorted(range(len(at)), key=lambda k: (run[at[k]], rest[k]))
        order[at] = order[at[by]]
        new[at[1:]] |= np.array([rest[x] != rest[y] for x, y in zip(by[1:], by[:-1])], bool)
        run = np.cumsum(new)
    return order, run - 1


def _codes(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    d = column.fill_null("").dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def slice_counts(data: np.ndarray, off: np.ndarray, lang: pa.Array, source: pa.Array) -> pa.RecordBatch:
    """(lang, source, term, n, docs) of a slice of documents."""
    data = lower(data)
    start, end, doc = word_spans(data, off, _APART)
    (lang_of, langs), (source_of, sources) = _codes(lang), _codes(source)
    order, run = pointer_sort(data, start, end - start, lang_of[doc])
    doc, src = doc[order], source_of[doc[order]]
    by = np.lexsort((doc, src, run))
    order, run, doc, src = order[by], run[by], doc[by], src[by]
    head = np.flatnonzero(_changes(run, src))
    n = np.diff(np.append(head, len(run)))
    docs = np.add.reduceat(_changes(run, src, doc).astype(np.int64), head) if len(head) else head
    at, size = start[order[head]], (end - start)[order[head]]
    edge = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(edge[-1]) + np.repeat(at - edge[:-1], size)
    term = pa.Array.from_buffers(pa.large_string(), len(head), [None, pa.py_buffer(edge.astype(np.int64).tobytes()), pa.py_buffer(data[place].tobytes())])
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(lang_of[doc[head]])), sources.take(pa.array(src[head])), term.cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
        ["lang", "source", "term", "n", "docs"],
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def counted() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        data, off = as_bytes(t["text"])
        lang, source = (t[c].combine_chunks() for c in ("lang", "source"))
        lang, source = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (lang, source))
        for i, j in slices(off, SLICE):
            yield slice_counts(data[off[i] : off[j]], off[i : j + 1] - off[i], lang.slice(i, j - i), source.slice(i, j - i))

    for batch in batches:  # small batches are put together, so that equal terms meet
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.column("text").nbytes for b in held) >= SLICE:
            yield from counted()
    if held:
        yield from counted()


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, sources array<struct<source, n>>) of the kept terms, stored."""
    texts = docs.select("lang", "source", "text")
    counts = texts.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    counts = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    return stored(terms.where(F.col("docs") >= min_docs).select("lang", "term", "sources"), "divergence-terms")


def likelihood(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / total) by long division, three digits at a time."""
    out, rest = F.lit(0).cast("long"), n + 1
    div = lambda a, b: F.call_function("div", a, b)
    out, rest = div(rest, total), rest % total
    for _ in range(3):
        out, rest = out * 1000 + div(rest * 1000, total), (rest * 1000) % total
    return out + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def group_sizes(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total) of every occurring group, total being N + V;
    lang_total is null where the language keeps no term."""
    groups = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    v = terms.groupBy("lang").agg(
        F.count("*").alias("v"), F.sum(F.aggregate("sources", F.lit(0).cast("long"), lambda a, s: a + s["n"])).alias("lang_n")
    )
    n = terms.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("source")).agg(F.sum("s.n").alias("n"))
    return groups.join(v, "lang", "left").join(n, ["lang", "source"], "left").select(
        "lang", "source", (F.coalesce("n", F.lit(0)) + F.col("v")).alias("total"), (F.col("lang_n") + F.col("v")).alias("lang_total"),
    )


def leading_terms(terms: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): each group's terms over the language's share."""
    lang_n = F.aggregate("sources", F.lit(0).cast("long"), lambda a, s: a + s["n"])
    rows = terms.select("lang", "term", lang_n.alias("lang_n"), F.explode("sources").alias("s"))
    rows = rows.select("lang", "term", "lang_n", "s.source", "s.n").join(groups, ["lang", "source"])
    p, q = likelihood(F.col("n"), F.col("total")), likelihood(F.col("lang_n"), F.col("lang_total"))
    rows = rows.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where(F.col("p") > F.col("q"))
    rows = rows.select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _pair_sums(groups: dict[str, list[tuple[str, int]]]):
    """``groups``: by lang, its sources and their totals."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        place = {lang: {s: k for k, (s, _) in enumerate(own)} for lang, own in groups.items()}
        total = {lang: np.array([t for _, t in own], np.int64) for lang, own in groups.items()}
        for batch in batches:
            langs = batch.column("lang")
            for lang in langs.unique().to_pylist():
                lists = batch.column("sources").filter(pa.compute.equal(langs, lang))
                flat, n_sources = lists.flatten(), len(place[lang])
                size = np.asarray(pa.compute.list_value_length(lists), np.int64)
                row = np.repeat(np.arange(len(size)), size)
                d = flat.field("source").dictionary_encode()
                name = np.array([place[lang][s] for s in d.dictionary.to_pylist()], np.int64)
                col, n = name[d.indices.to_numpy()], flat.field("n").to_numpy()
                step = max(1, CELLS // n_sources)
                for i in range(0, len(size), step):
                    here = slice(*np.searchsorted(row, [i, i + step]))
                    counts = np.zeros((min(step, len(size) - i), n_sources), np.int64)
                    counts[row[here] - i, col[here]] = n[here]
                    p, rest = np.divmod(counts + 1, total[lang])
                    for _ in range(3):
                        more, rest = np.divmod(rest * 1000, total[lang])
                        p = p * 1000 + more
                    p = np.ascontiguousarray((p + 1).T)  # by source
                    own = sums.setdefault(lang, np.zeros((n_sources, n_sources), np.int64))
                    for g in range(n_sources):
                        own[g] += (np.square(p[g] - p) // p).sum(axis=1)
        for lang, own in sums.items():
            names = np.array([s for s, _ in groups[lang]], object)
            for g, source in enumerate(names):
                other = np.arange(len(names)) != g
                yield pa.RecordBatch.from_pydict(
                    {"lang": [lang] * int(other.sum()), "source": [source] * int(other.sum()), "item": names[other].tolist(), "value": own[g][other]}, schema
                )

    return run


def pair_sums(terms: DataFrame, groups: list) -> DataFrame:
    """(lang, source, item, value) of the languages with kept terms, by task."""
    by: dict[str, list[tuple[str, int]]] = {}
    for r in groups:
        if r.total is None:  # its language keeps no term
            continue
        by.setdefault(r.lang, []).append((r.source, r.total))
    return terms.select("lang", "sources").mapInArrow(_pair_sums(by), "lang string, source string, item string, value long")


def pair_sums_joined(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """The same by joins, for any number of groups: each group's p for every kept term."""
    dense = terms.join(groups.select("lang", "source", "total"), "lang").select(
        "lang", "term", "source", "total", F.get(F.filter("sources", lambda s: s["source"] == F.col("source")), F.lit(0))["n"].alias("n")
    )
    p = dense.select("lang", "term", "source", likelihood(F.coalesce("n", F.lit(0)), F.col("total")).alias("p"))
    q = p.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"))
    pairs = p.join(q, ["lang", "term"]).where(F.col("source") != F.col("item"))
    return pairs.select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))


def pair_divergence(terms: DataFrame, groups: DataFrame, max_groups: int = MAX_GROUPS) -> DataFrame:
    """(lang, source, item, value, rank) of every ordered pair of a language's sources."""
    some = groups.limit(max_groups + 1).collect()
    sums = pair_sums(terms, some) if len(some) <= max_groups else pair_sums_joined(terms, groups)
    # a language without kept terms has pairs of value 0
    none = groups.where(F.col("total").isNull())
    other = none.select("lang", F.col("source").alias("item"))
    zero = none.join(other, "lang").where(F.col("source") != F.col("item")).select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    value = sums.unionByName(zero).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return value.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, max_groups: int = MAX_GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term``."""
    terms = term_counts(docs, min_docs)
    groups = stored(group_sizes(docs, terms), "divergence-groups")
    pair = pair_divergence(terms, groups, max_groups).withColumn("part", F.lit("pair"))
    term = leading_terms(terms, groups, top).withColumn("part", F.lit("term"))
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", "rank")

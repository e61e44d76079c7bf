"""Quality rules: fixed word rules plus a hashed n-gram likelihood ratio.

Word unigrams and bigrams are hashed into BUCKETS.  A bucket's weight is the log
of its count in trusted documents over the count expected there from the whole
corpus, both shrunk by PRIOR; a document's score is the mean weight of its
n-grams.  A document is kept when no fixed rule fails and its score is not under
the threshold, which is the TRUSTED_LOST quantile of the trusted documents'
scores.  The corpus multinomial counts every document; the trusted multinomial
and the threshold count every trusted document.

Only DataFrame functions run.  Weights are whole millionths, so a score is an
exact sum whatever the order of the rows.

Null or empty text: no words, so the fixed rules reject it.  Repeated rows are
scored alike, each on its own.  Without trusted documents every weight and the
threshold are 0: only the fixed rules decide.  Other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.common import stored

BUCKETS = 1 << 14
PRIOR = 5.0
TRUSTED_LOST = 0.005
UNIT = 1_000_000
BINS = 10_000  # of scores, for each unit of the ratio
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
A_WORD = r"[^\x20\x09-\x0D]"


def _words(text: str) -> Column:
    inner = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def _runs(a: str, width_b: int, shift: int, b: str, n: Column) -> Column:
    """Rolling XOR hash of a[i] followed by b[i + shift], for the first n places."""
    size = F.greatest(n, F.lit(0))
    return F.zip_with(
        F.slice(a, F.lit(1), size), F.slice(b, F.lit(1 + shift), size),
        lambda x, y: F.shiftleft(x, width_b).bitwiseXOR(y),
    )


def _bigrams() -> Column:
    return _runs("__hw", 1, 1, "__hw", F.size("__hw") - 1)


def hashed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with __hw (word hashes) and __bi (bigram hashes), without the text."""
    d = docs.select("*", F.transform(_words(text), lambda w: F.xxhash64(w)).alias("__hw")).drop(text)
    return d.withColumn("__bi", _bigrams())


def _repeats(hashes: str) -> Column:
    return F.size(F.array_distinct(hashes)) < F.size(hashes)


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of the fixed rules, base_failed, __hw and __bi."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda x: x.rlike(A_WORD))
    d = docs.withColumns({"__w": _words(text), "__l": lines})
    d = d.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.length(F.array_join("__w", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), NOT_SYMBOLS, "")).cast("long"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
            "__hw": F.transform("__w", lambda w: F.xxhash64(w)),
        }
    ).drop("__w", "__l")
    d = d.withColumn("__bi", _bigrams())
    # five-word windows only where a four-word run occurs twice
    d = d.withColumn("__h4", _runs("__bi", 2, 2, "__bi", F.size("__hw") - 3))
    h5 = _runs("__h4", 1, 4, "__hw", F.size("__hw") - 4)
    d = d.withColumn("__h5", F.when(_repeats("__h4"), h5)).drop("__h4")
    at = F.zip_with("__h5", F.sequence(F.lit(1), F.size("__h5")), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    d = d.withColumn("__at", F.when(F.col("__h5").isNotNull() & _repeats("__h5"), F.sort_array(at))).drop("__h5")
    m = F.size("__at") - 1
    both = F.zip_with(
        F.slice("__at", F.lit(1), m), F.slice("__at", F.lit(2), m),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
    )
    d = d.withColumn("__p", F.when(F.col("__at").isNotNull(), F.sort_array(F.array_distinct(F.flatten(both))))).drop("__at")
    m = F.size("__p") - 1
    steps = F.zip_with(
        F.slice("__p", F.lit(1), m), F.slice("__p", F.lit(2), m), lambda a, b: F.least(b - a, F.lit(WINDOW))
    )
    covered = F.aggregate(steps, F.lit(WINDOW), lambda s, x: s + x)
    d = d.withColumn("n_repeat_words", F.when(F.col("__p").isNull(), 0).otherwise(covered).cast("long")).drop("__p")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return d.withColumn("base_failed", failed)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id) of every trusted document, once each."""
    one = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # stored: beside a join of its own, a skewed partition of documents can be split
    return stored(one.filter("quality = 1").select("doc_id"), "quality-trusted")


def weights(docs: DataFrame, trusted: DataFrame) -> list[int]:
    """Weight of each bucket in units; ``trusted``: (doc_id), each once."""
    marked = docs.select("doc_id", "text").join(trusted.select("doc_id", F.lit(1).alias("t")), "doc_id", "left")
    grams = hashed(marked).select("t", F.explode(F.concat("__hw", "__bi")).alias("h"))
    counts = (
        grams.groupBy(F.pmod("h", F.lit(BUCKETS)).cast("int").alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.count("t").alias("k"))
        .collect()  # at most BUCKETS rows
    )
    n_all, n_trusted = sum(r["n"] for r in counts), sum(r["k"] for r in counts)
    out = [0] * BUCKETS
    for r in counts:
        expected = n_trusted * r["n"] / n_all
        out[r["b"]] = round(UNIT * math.log((r["k"] + PRIOR) / (expected + PRIOR)))
    return out


def _total(grams: str, table: Column) -> Column:
    place = lambda h: (F.pmod(h, F.lit(BUCKETS)) + 1).cast("int")
    return F.aggregate(grams, F.lit(0).cast("long"), lambda s, h: s + F.element_at(table, place(h)))


def score(d: DataFrame, weight: list[int]) -> DataFrame:
    """Add ``ratio``: the mean weight of the n-grams (0 without any)."""
    table = F.split(F.lit(",".join(map(str, weight))), ",").cast("array<bigint>")  # folded to one literal
    n = F.size("__hw") + F.size("__bi")
    total = _total("__hw", table) + _total("__bi", table)
    return d.withColumn("ratio", F.when(n > 0, total / (F.lit(float(UNIT)) * n)).otherwise(0.0)).drop("__hw", "__bi")


def quantile(ratios: DataFrame, part: float) -> float:
    """Exact quantile of ``ratio``, between two neighbours in proportion; 0 without rows.
    Counts by bin are collected first, then those by ratio of the one or two bins that
    the neighbours are in."""
    place = F.floor(F.col("ratio") * BINS)
    bins = sorted((r["b"], r["n"]) for r in ratios.groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(n for _, n in bins)
    if not total:
        return 0.0
    at = part * (total - 1)
    ends = [math.floor(at), math.ceil(at)]
    before, first, inside = 0, None, []
    for b, n in bins:
        if any(before <= k < before + n for k in ends):
            first = before if first is None else first
            inside.append(b)
        before += n
    near = ratios.filter(place.isin(inside)).groupBy("ratio").agg(F.count(F.lit(1)).alias("n")).collect()
    found = []
    for k in ends:
        before = first
        for x, n in sorted((r["ratio"], r["n"]) for r in near):
            if before <= k < before + n:
                found.append(x)
                break
            before += n
    low, high = found
    return low + (high - low) * (at - ends[0])


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the text, with the rule columns, ratio, base_failed and kept."""
    trusted = trusted_ids(labels)
    weight = weights(docs, trusted)
    # scored before the join, so that ids and scores are dealt instead of texts
    every = score(hashed(docs.select("doc_id", "text")), weight)
    seen = stored(every.join(trusted, "doc_id").select("ratio"), "quality-scores")
    least = quantile(seen, TRUSTED_LOST)
    d = score(base_columns(docs), weight).drop("text")
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= F.lit(least)))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged, whatever their names.

    The caller's columns travel in one struct beside the verdict; both are stored, so the
    rules are evaluated once, and the filter runs on the stored verdict.
    """
    row = F.col("__row")
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    verdict = stored(judged(rows, labels).select("__row", "kept"), "quality-verdict")
    return verdict.filter("kept").select(*[row.getField(c).alias(c) for c in docs.columns])

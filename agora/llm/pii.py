"""Personal data: fixed patterns plus bootstrapped contextual extraction.

Base kinds (email, ip, card, phone) are found by fixed patterns and checks.  The
method adds identifiers that those miss: occurrences of "cue connector value"
(``token = "..."``) form a graph of lexical patterns (cue, connector) and instances
(the value).  Seeds are values that are a base entity by themselves or a long key
of mixed letters and digits.  Rounds of scoring follow: a pattern's confidence is
the mean confidence of its distinct instances, shrunk by one doubtful instance;
an instance takes the confidence of its best accepted pattern.  A pattern is
accepted at ACCEPT with MIN_SEEDS distinct confident instances; every occurrence
of an accepted pattern is then a span, also when its value was never seen before.  Cues and
values have no greatest length; after a phone's or card's cue a value may be a number
written in groups, with or without a country code.

Only DataFrame functions run.  The text passes twice over the scan; the graph holds
one row for each occurrence, pre-aggregated by pattern and value before it shuffles.

Offsets are code points, the end exclusive.  Null text: empty, no spans.  Repeated
rows get the same spans.  Base spans always stay; an added span that overlaps one
is dropped.  Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
GROUPED = ("card", "phone")  # kinds whose values may hold spaces and brackets
ADDED = "secret"  # kind of an added span whose pattern was induced by key-like seeds

# The base kinds' patterns, written so that a failing run is not tried again from
# each of its characters: a match starts where its run of characters starts, or
# where the last match ended (\G).  Possessive parts cannot overflow the stack.
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# a cheap test that a text has a match at all
HINT = {
    "email": r"@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"(?:[0-9][\x20-]?){15}[0-9]",
    "phone": r"\+[0-9]",
}
CUE = r"(?<![\p{L}_-])[\p{L}_-]{2,}+"
CONNECTOR = r"\x20?[:=#]\x20?[\x22']?"
# six characters or more, the last one a letter or digit; no upper limit
TOKEN = (
    r"\+?(?=[A-Za-z0-9][A-Za-z0-9._%+@/-]{4}[A-Za-z0-9._%+@/-]*?[A-Za-z0-9])"
    r"[A-Za-z0-9]++(?:[._%+@/-]++[A-Za-z0-9]++)*+"
)
# 8 to 19 digits as phones and cards are written, no further digit or token after them
NUMBER = r"\+?\(?[0-9](?:[\x20().-]*+[0-9]){7,18}+(?![\x20().-]*+[0-9])(?![._%+@/-]*+[A-Za-z0-9])"
HEAD = f"^{CUE}{CONNECTOR}"
OCCURRENCE = f"{CUE}{CONNECTOR}(?:{NUMBER}|{TOKEN})"
KEY = r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_/-]{24,}$"

ROUNDS = 3
ACCEPT = 0.7
MIN_SEEDS = 3


def _text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>> of the leftmost non-overlapping matches."""
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kind = "struct<pos:int,out:array<struct<s:int,e:int,m:string>>>"
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out")).cast(kind)

    def add(acc: Column, x: Column) -> Column:
        at = acc["pos"] + F.length(x["p"])
        end = at + F.length(x["m"])
        one = F.struct(at.alias("s"), end.alias("e"), x["m"].alias("m"))
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(one)).alias("out")).cast(kind)

    both = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.struct(p.alias("p"), m.alias("m")))
    return F.aggregate(both, start, add, lambda acc: acc["out"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _is_ip(m: Column) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda x: F.regexp_replace(x, "^0+(?=.)", ""))
    return F.forall(parts, lambda x: (F.length(x) <= 3) & (F.lpad(x, 3, "0") <= "255"))


def _is_card(m: Column) -> Column:
    back = F.reverse(_digits(m))
    places = F.sequence(F.lit(1), F.length(back))

    def add(total: Column, i: Column) -> Column:
        d = back.substr(i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    fits = F.length(back).between(16, 19)
    return fits & F.when(fits, F.aggregate(places, F.lit(0), add) % 10 == 0).otherwise(False)


CHECK = {
    "email": lambda m: F.lit(True),
    "ip": _is_ip,
    "card": _is_card,
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
}


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one array<struct<s, e>> column for each base kind."""
    t = _text(text)
    none = F.array().cast("array<struct<s:int,e:int>>")

    def of(kind: str) -> Column:
        good = F.filter(_spans(t, PATTERN[kind]), lambda x: CHECK[kind](x["m"]))
        ends = F.transform(good, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
        return F.when(t.rlike(HINT[kind]), ends).otherwise(none)

    return docs.withColumns({kind: of(kind) for kind in KINDS})


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, th, s, e, e_number, pattern, value, kind): each "cue connector value";
    kind is that of the seed the value is, or null.  e ends the token (null: none),
    e_number a number in groups, which only phones and cards are."""
    t = _text("text")
    hits = docs.filter(t.rlike(r"[:=#]\x20?[\x22']?[+(A-Za-z0-9]")).select(
        "doc_id", F.xxhash64("text").alias("th"), F.explode(_spans(t, OCCURRENCE)).alias("o")
    )
    head = F.regexp_extract(F.col("o.m"), HEAD, 0)
    hits = hits.select("doc_id", "th", "o.s", "o.m", head.alias("head"))
    number = F.col("m").substr(F.length("head") + 1, F.length("m"))
    hits = hits.select(
        "doc_id", "th", (F.col("s") + F.length("head")).alias("s"),
        F.lower(F.regexp_replace("head", r"\x20", "")).alias("pattern"),
        number.alias("number"), F.regexp_extract(number, f"^{TOKEN}", 0).alias("token"),
    ).filter(F.col("number").rlike("[0-9]"))
    hits = hits.select("*", _seed(F.col("token")).alias("kind"), _seed(F.col("number")).alias("n_kind"))
    grouped = F.col("kind").isNull() & (F.col("n_kind").isin(*GROUPED) | (F.col("token") == ""))
    return hits.select(
        "doc_id", "th", "s",
        F.when(F.col("token") != "", F.col("s") + F.length("token")).alias("e"),
        (F.col("s") + F.length("number")).alias("e_number"), "pattern",
        F.when(grouped, F.col("number")).otherwise(F.col("token")).alias("value"),
        F.when(grouped, F.col("n_kind")).otherwise(F.col("kind")).alias("kind"),
    )


def _seed(v: Column) -> Column:
    """Kind of the seed that the value is, or null."""
    whole = lambda k: v.rlike(f"^(?:{PATTERN[k]})$")
    return (
        F.when(whole("email"), "email")
        .when(whole("ip") & _is_ip(v), "ip")
        .when(whole("card") & _is_card(v), "card")
        .when(whole("phone") & CHECK["phone"](v), "phone")
        .when(v.rlike(KEY), ADDED)
    )


def accepted_patterns(occ: DataFrame) -> DataFrame:
    """(pattern, kind, conf) after ROUNDS of scoring over the pattern-instance graph."""
    edges = occ.groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
    edges = edges.withColumn("conf", F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0))
    good = None
    for turn in range(ROUNDS):
        edges = stored(edges, f"pii-{turn}")
        scored = edges.groupBy("pattern").agg(
            (F.sum("conf") / (F.count(F.lit(1)) + 1)).alias("p_conf"),
            F.sum((F.col("conf") >= ACCEPT).cast("int")).alias("n_sure"),
            F.mode("kind").alias("p_kind"),
        )
        good = scored.filter((F.col("p_conf") >= ACCEPT) & (F.col("n_sure") >= MIN_SEEDS))
        if turn == ROUNDS - 1:
            break
        best = edges.join(good, "pattern").groupBy("value").agg(F.max(F.struct("p_conf", "p_kind")).alias("b"))
        edges = edges.join(best, "value", "left").select(
            "pattern", "value", F.coalesce("kind", F.col("b.p_kind")).alias("kind"),
            F.greatest("conf", F.coalesce(F.col("b.p_conf"), F.lit(0.0))).alias("conf"),
        )
    return good.select("pattern", F.coalesce("p_kind", F.lit(ADDED)).alias("kind"), F.col("p_conf").alias("conf"))


def added_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, th, added array<struct<kind, s, e>>): spans of accepted patterns."""
    occ = stored(occurrences(docs), "pii-occurrences")
    found = occ.drop("kind").join(accepted_patterns(occ), "pattern")
    end = F.when(F.col("kind").isin(*GROUPED), F.col("e_number")).otherwise(F.col("e"))
    found = found.withColumn("e", end).filter("e IS NOT NULL")
    one = F.struct("kind", "s", "e")
    return found.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set(one)).alias("added"))


def find(docs: DataFrame) -> DataFrame:
    """``docs`` without the text, with email, ip, card, phone and added spans."""
    base = base_spans(docs).withColumn("__th", F.xxhash64("text")).drop("text")
    more = added_spans(docs).withColumnRenamed("doc_id", "__id").withColumnRenamed("th", "__h")
    d = base.join(more, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__th") == F.col("__h")), "left")
    known = F.concat(*KINDS)
    clear = F.filter(
        F.coalesce("added", F.array().cast("array<struct<kind:string,s:int,e:int>>")),
        lambda a: ~F.exists(known, lambda b: (a["s"] < b["e"]) & (b["s"] < a["e"])),
    )
    return d.withColumn("added", clear).drop("__id", "__h", "__th")


def _named(kind: str) -> Column:
    return F.transform(kind, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))


def _of_kind(kind: str) -> Column:
    """All spans of a base kind, added ones included, by start."""
    added = F.filter("added", lambda x: x["kind"] == kind)
    ends = F.transform(added, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    return F.transform(
        F.sort_array(F.concat(F.col(kind), ends)),
        lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")),
    )


def report(found: DataFrame) -> DataFrame:
    """Counts and the joined spans of ``find``: base kinds in their order, then others."""
    base = F.concat(*map(_named, KINDS))
    rest = F.transform(
        F.filter("added", lambda x: ~x["kind"].isin(*KINDS)),
        lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string")),
    )
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*map(_of_kind, KINDS), rest), ",").alias("spans"),
    )


def _marks(kind: str) -> Column:
    return F.transform(kind, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("k")))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; all other columns, of
    whatever name, as they were."""
    names, row = docs.columns, F.col("__row")  # the caller's columns travel in one struct
    d = find(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row")))
    d = d.withColumn("__text", row.getField("text"))
    added = F.transform("added", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("k")))
    d = d.withColumn("__m", F.sort_array(F.concat(*map(_marks, KINDS), added)))
    kind = "struct<pos:int,out:array<string>>"

    def put(acc: Column, x: Column) -> Column:
        # spans of different kinds may overlap: the later one starts where the earlier ended
        gap = F.col("__text").substr(acc["pos"] + 1, F.greatest(x["s"] - acc["pos"], F.lit(0)))
        new = F.when(x["s"] >= acc["pos"], F.array(gap, F.concat(F.lit("<"), x["k"], F.lit(">")))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(acc["pos"], x["e"]).alias("pos"), F.concat(acc["out"], new).alias("out")).cast(kind)

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out")).cast(kind)
    text = F.aggregate(
        "__m", start, put,
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.col("__text").substr(acc["pos"] + 1, F.length("__text"))),
    )
    text = F.when(F.size("__m") > 0, text).otherwise(F.col("__text"))
    return d.select(*[text.alias("text") if c == "text" else row.getField(c).alias(c) for c in names])

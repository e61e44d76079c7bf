"""Mixing sources to target weights by the cube method.

Every source gets a target number of words.  A document's expected number of
copies is target / source size; its whole part is taken for certain and the
fractional part is drawn by the cube method, which moves the fractional
probabilities through the null space of two constraints per source (documents
and words), so both totals stay where they were while one probability after
the other reaches 0 or 1.

The flight runs on chunks of a source (a hot source is many chunks).  A chunk
holds LANDING units back, a ladder of sizes up to its largest whose sums leave no wide
gap, and leaves at most two others open; these
meet in wider chunks of the same source, level by level, until LANDING + 2 are
left, for which the landing tries every choice.

Null text: size 0.  Null source: a source of its own, ordered last.  Rows that
share doc_id and source are one unit of the draw (all or none).  An empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import random
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from agora.llm.common import WORD, stored

WEIGHTS = (1, 2, 3)  # by rank of the source, repeating
MOST = 3  # copies of a document at most
CHUNK = 20_000  # units whose flight one task runs at once
LANDING = 12  # units of a chunk kept for the landing
LEVELS = 4  # enough for CHUNK * (CHUNK / 20) ** (LEVELS - 1) units a source
EPS = 1e-9


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of each whole text."""
    return docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    )


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, n_docs, target): one row per source.

    A source is capped when its share by weight is above MOST times its size.
    Sorted by MOST * size / weight the capped sources are a prefix, so the level
    at which the others share the rest comes from running sums.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    by = by.withColumn("w", weight).withColumn("r", F.lit(MOST) * F.col("source_size") / F.col("w"))
    every = Window.orderBy("r", F.col("source").asc_nulls_last())
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    rest = every.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    by = by.withColumn(
        "level",
        (F.sum("source_size").over(whole) - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        / F.sum("w").over(rest),
    )
    # the first source, in this order, whose own bound is not under the level
    by = by.withColumn("at", F.min(F.when(F.col("r") >= F.col("level"), F.struct("r", "level"))).over(whole)["level"])
    cap = (F.lit(MOST) * F.col("source_size")).cast("double")
    return by.select(
        "source", "source_size", "n_docs",
        F.coalesce(F.least(cap, F.col("at") * F.col("w")), cap).alias("target"),
    )


def _uniform(seed: int, *key: object) -> random.Random:
    return random.Random(f"{seed}|" + "|".join(map(str, key)))


def flight(size: list[int], p: list[float], rng: random.Random, open_: list[int]) -> list[float]:
    """Move ``p`` at the places ``open_`` through the null space of (count, words) until
    at most two are strictly between 0 and 1; the sums of p and of size * p stay."""
    p = list(p)
    live: list[int] = []
    for k in open_:
        live.append(k)
        if len(live) < 3:
            continue
        i, j, m = live
        a, b, c = size[i], size[j], size[m]
        u = (1, -1, 0) if a == b == c else (b - c, c - a, a - b)
        up = down = float("inf")
        for v, x in zip(u, live):
            if v > 0:
                up, down = min(up, (1 - p[x]) / v), min(down, p[x] / v)
            elif v < 0:
                up, down = min(up, p[x] / -v), min(down, (1 - p[x]) / -v)
        move = up if rng.random() * (up + down) < down else -down
        left = []
        for v, x in zip(u, live):
            p[x] += move * v
            if EPS < p[x] < 1 - EPS:
                left.append(x)
            else:
                p[x] = float(round(p[x]))
        live = left
    return p


def landing(size: list[int], p: list[float], open_: list[int]) -> list[float]:
    """Settle the open units (LANDING + 2 at most): of all choices the one whose words and
    documents are nearest to expectation."""
    if not open_:
        return p
    s, q = np.array([size[k] for k in open_], float), np.array([p[k] for k in open_])
    picks = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    off = np.abs(picks @ s - q @ s) + 0.02 * s.mean() * np.abs(picks.sum(1) - q.sum())
    p = list(p)
    for k, x in zip(open_, picks[int(off.argmin())]):
        p[k] = float(x)
    return p


def ladder(falling: list[int], step: int) -> list[int] | None:
    """Places of units whose sums reach every amount up to their total within ``step``,
    the largest unit included; None if that takes more than LANDING of them."""
    rising, total, picked = [-x for x in falling], 0, []
    while len(picked) < LANDING:
        # the largest unit left that leaves no gap above the sums so far
        k = bisect_left(rising, -(total + step))
        while k in picked:
            k += 1
        if k >= len(falling):
            return None
        picked.append(k)
        total += falling[k]
        if k == 0:
            return picked
    return None


def held_back(open_: list[int], size: list[int]) -> list[int]:
    """Of the open units, by falling size: those of the finest ladder, then the largest."""
    falling = [size[k] for k in open_]
    step, rungs = 1, None
    while open_ and rungs is None:
        rungs, step = ladder(falling, step), 2 * step
    rungs = rungs or []
    more = [k for k in range(min(len(open_), 2 * LANDING)) if k not in rungs]
    return [open_[k] for k in rungs + more[: LANDING - len(rungs)]]


def _level(units: DataFrame, level: int, seed: int, last: bool) -> DataFrame:
    def move(key: tuple, t: pa.Table) -> pa.Table:
        source, chunk = (x.as_py() for x in key)
        # units of all sizes wait for the landing, where they balance each other
        t = t.sort_by([("size", "descending"), ("doc_id", "ascending")])
        size, p = t["size"].to_pylist(), t["p"].to_pylist()
        p = [x if EPS < x < 1 - EPS else float(round(x)) for x in p]
        open_ = [k for k, x in enumerate(p) if 0 < x < 1]
        held = set(held_back(open_, size))
        p = flight(size, p, _uniform(seed, level, source, chunk), [k for k in open_ if k not in held])
        if last:
            p = landing(size, p, [k for k in open_ if 0 < p[k] < 1])
        return t.set_column(t.column_names.index("p"), "p", pa.array(p, pa.float64()))

    return units.groupBy("source", "chunk").applyInArrow(move, units.schema)


def draw(units: DataFrame, seed: int = 9) -> DataFrame:
    """Cube sampling of units (doc_id, source, size, n_docs, p): p becomes 0 or 1."""
    n_chunks = F.ceil(F.col("n_docs") / F.lit(CHUNK))
    units = units.select(
        "doc_id", "source", "size", "p",
        F.pmod(F.xxhash64("doc_id"), F.greatest(n_chunks, F.lit(1))).cast("long").alias("chunk"),
    )
    is_open = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    out = None
    for level in range(LEVELS):
        last = level == LEVELS - 1
        if level:
            units = units.withColumn("chunk", F.floor(F.col("chunk") / F.lit(CHUNK // 20)) if not last else F.lit(0).cast("long"))
        moved = _level(units, level, seed, last)
        if not last:
            moved = stored(moved, f"mixing-{level}")
        done = moved if last else moved.filter(~is_open)
        out = done if out is None else out.unionByName(done)
        units = moved.filter(is_open)
    return out.select("doc_id", "source", F.col("p").cast("int").alias("drawn"))


def mix(docs: DataFrame, seed: int = 9) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row."""
    sized = stored(sizes(docs), "mixing-sizes")
    goal = targets(sized)
    unit = sized.groupBy("doc_id", "source").agg(F.sum("size").alias("size"))
    unit = unit.alias("u").join(goal.alias("t"), F.expr("u.source <=> t.source")).select(
        "u.doc_id", "u.source", "u.size", "n_docs", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("ratio"),
    )
    unit = unit.withColumn("whole", F.floor(F.col("ratio") + F.lit(EPS)).cast("int"))
    unit = stored(unit.withColumn("p", F.greatest(F.lit(0.0), F.col("ratio") - F.col("whole"))), "mixing-units")
    drawn = draw(unit, seed)
    same = F.expr("a.doc_id <=> b.doc_id AND a.source <=> b.source")
    taken = unit.alias("a").join(drawn.alias("b"), same).select(
        "a.doc_id", "a.source", "source_size", "target", (F.col("whole") + F.col("drawn")).alias("copies")
    )
    return sized.alias("a").join(taken.alias("b"), same).select(
        "a.doc_id", "a.source", "a.size", "source_size", "target", "copies",
        (F.col("a.size") * F.col("copies")).cast("long").alias("taken"),
    )


def mix_documents(docs: DataFrame, seed: int = 9, copy: str = "copy") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its copy number
    in ``copy``; beside a column of that name (in any case) the number's column gets
    underscores after its name until it is free."""
    while copy.lower() in map(str.lower, docs.columns):
        copy += "_"
    copies = mix(docs, seed).groupBy("doc_id", "source").agg(F.max("copies").alias("copies")).filter("copies > 0")
    rows = docs.alias("a").join(copies.alias("b"), F.expr("a.doc_id <=> b.doc_id AND a.source <=> b.source"))
    again = F.explode(F.sequence(F.lit(1), F.col("b.copies"))).alias(copy)
    return rows.select("a.*", again)

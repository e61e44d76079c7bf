"""Nested comment JSON of any depth, walked by a recursive query."""

import json
import random

from agora.plans import comment_trees, ingest
from agora.schemas import COMMENT_SNAPSHOT


def posts(spark, rows):
    return spark.createDataFrame([(p, c if c is None or isinstance(c, str) else json.dumps(c)) for p, c in rows], "post_id string, comments string")


def flattened(tree, post, parent=None, depth=0):
    for c in tree:
        if not isinstance(c, dict):
            continue
        below = c.get("replies") if isinstance(c.get("replies"), list) else []
        if c.get("comment_id") is None:
            yield from flattened(below, post, parent, depth)
            continue
        own = list(flattened(below, post, c["comment_id"], depth + 1))
        direct = sum(1 for r in own if r[1] == c["comment_id"])
        yield (post, parent, c["comment_id"], c.get("author_name"), c.get("score"), direct or None, depth)
        yield from own


def rows(df):
    return sorted(((r.post_id, r.parent_id, r.comment_id, r.author_name, r.score, r.replies, r.depth) for r in df.collect()), key=str)


def test_trees_of_random_shape(spark):
    rng, ids = random.Random(5), iter(range(10**6))

    def tree(depth):
        out = []
        for _ in range(rng.randrange(4)):
            c = {"author_name": rng.choice(["a", None]), "score": rng.choice([0, 3]), "replies": tree(depth - 1) if depth else rng.choice([[], None, ""])}
            if rng.random() < 0.85:
                c["comment_id"] = f"c{next(ids)}"
            out.append(c)
        return out + rng.choice([[], [None], ["more"], [7]])

    data = [(f"p{i}", tree(5)) for i in range(40)]
    got = comment_trees.flat_comments(posts(spark, data))
    assert got.columns == [*COMMENT_SNAPSHOT.names, "depth"]
    assert rows(got) == sorted((r for p, t in data for r in flattened(t, p)), key=str)


def test_a_chain_far_deeper_than_any_schema(spark):
    chain = None
    for k in range(150, -1, -1):
        chain = {"comment_id": str(k), "replies": [chain] if chain else []}
    got = {r.comment_id: (r.parent_id, r.depth, r.replies) for r in comment_trees.flat_comments(posts(spark, [("p", [chain])])).collect()}
    assert len(got) == 151
    assert got["0"] == (None, 0, 1) and got["150"] == ("149", 150, None)


def test_bad_and_empty_texts(spark):
    data = [("a", None), ("b", ""), ("c", "[]"), ("d", "{oops"), ("e", '{"comment_id": "x"}'), ("f", '[{"comment_id": "y", "score": "many", "replies": {}}]'), (None, '[{"comment_id": "z"}]')]
    df = posts(spark, data)
    good, bad = comment_trees.split_trees(df)
    assert sorted(r.post_id or "-" for r in good.collect()) == ["-", "a", "c", "f"]
    assert sorted(r.post_id for r in bad.collect()) == ["b", "d", "e"]
    got = {r.comment_id: (r.post_id, r.score, r.replies) for r in comment_trees.flat_comments(good).collect()}
    assert got == {"y": ("f", None, None), "z": (None, None, None)}
    assert comment_trees.flat_comments(posts(spark, [])).collect() == []


def test_trees_feed_the_ingest_with_replies(spark):
    tree = [{"comment_id": "a", "author_name": "u", "created_utc": 1704672000.5, "replies": [{"comment_id": "b", "created_utc": 1704672001}, {"comment_id": "c", "created_utc": 1704672001, "edited": "false"}]}]
    stored = spark.createDataFrame([("p", "s")], "post_id string, subreddit string")
    communities = spark.createDataFrame([("s", 1.0)], "subreddit_name string, subscribers_count double")
    got = ingest.ingest_comments(comment_trees.flat_comments(posts(spark, [("p", tree), ("other", tree)])).drop("depth"), stored, communities)
    assert {(r.comment_id, r.parent_id, r.replies, r.edited) for r in got.collect()} == {("a", None, 2, None), ("b", "a", None, None), ("c", "a", None, None)}


def test_walk_shuffles_nothing(spark):
    plan = comment_trees.walk(posts(spark, [("p", [])]))._jdf.queryExecution().executedPlan().toString()
    assert "UnionLoop" in plan and "Exchange" not in plan

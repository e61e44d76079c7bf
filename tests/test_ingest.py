"""Ingest operators: top-N, hot listing cap, day filter, cleaning, joins, trees."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from agora.operators import counts, joins, topn
from agora.plans import ingest
from agora.schemas import COMMENT_SNAPSHOT, POST_SNAPSHOT
from agora.sinks.batch import write_partitioned
from agora.sources import files

DAY = dt.date(2024, 1, 8)
EPOCH_DAY = 1704672000.0  # 2024-01-08 00:00:00 UTC


def communities_df(spark, rows):
    return spark.createDataFrame(rows, "subreddit_name string, subscribers_count double")


def snapshot_df(spark, rows):
    """rows: dicts with a subset of POST_SNAPSHOT fields."""
    full = [tuple(r.get(f.name) for f in POST_SNAPSHOT.fields) for r in rows]
    return spark.createDataFrame(full, POST_SNAPSHOT)


def test_top_communities_nan_and_null_last(spark):
    df = communities_df(
        spark, [("a", 10.0), ("b", float("nan")), ("c", None), ("d", 10.0), ("e", 50.0), ("f", 1.0)]
    )
    got = [r.subreddit_name for r in topn.top_communities(df, 6).collect()]
    assert got[:4] == ["e", "a", "d", "f"]
    assert set(got[4:]) == {"b", "c"}
    assert [r.subreddit_name for r in topn.top_communities(df, 2).collect()] == ["e", "a"]


def test_hot_listing_cap_then_day_filter(spark):
    rows = []
    for rank in range(1, 151):
        # Rank 50 was created the day before: dropped, and rank 101+ is not promoted.
        created = EPOCH_DAY - 10 if rank == 50 else EPOCH_DAY + rank
        rows.append(
            dict(snapshot_date=DAY, subreddit="big", hot_rank=rank, post_id=f"p{rank}", created=created, author_id="u")
        )
    rows.append(dict(snapshot_date=DAY, subreddit="small", hot_rank=1, post_id="s1", created=EPOCH_DAY, author_id="u"))
    rows.append(dict(snapshot_date=DAY, subreddit="other", hot_rank=1, post_id="o1", created=EPOCH_DAY, author_id="u"))
    snaps = snapshot_df(spark, rows)
    comms = communities_df(spark, [("big", 3.0), ("small", 2.0), ("other", 1.0)])
    out = ingest.ingest_posts(snaps, comms, run_date=DAY, top_n=2)
    got = {(r.subreddit, r.post_id) for r in out.collect()}
    assert ("other", "o1") not in got
    big = {p for s, p in got if s == "big"}
    assert len(big) == 99 and "p50" not in big and "p101" not in big
    assert ("small", "s1") in got
    r = out.where(F.col("post_id") == "s1").first()
    assert r.etl_ts == EPOCH_DAY and r.etl_date == DAY and r.num_comments == 0


def test_post_cleaning_and_rejects(spark):
    rows = [
        dict(snapshot_date=DAY, subreddit="c", hot_rank=1, post_id="a", created=EPOCH_DAY, author_id="u",
             ups=0, downs=0, over_18=False, title="", num_comments=None),
        dict(snapshot_date=DAY, subreddit="c", hot_rank=2, post_id="b", created=EPOCH_DAY, author_id=None,
             author_name=None),  # deleted author: rejected
        dict(snapshot_date=DAY, subreddit="c", hot_rank=3, post_id="c", created=EPOCH_DAY, author_name="n",
             over_18=True, ups=7, num_comments=4),
    ]
    comms = communities_df(spark, [("c", 1.0)])
    out, rejected = ingest.ingest_posts(snapshot_df(spark, rows), comms, run_date=DAY, with_rejected=True)
    got = {r.post_id: r for r in out.collect()}
    assert set(got) == {"a", "c"}
    a = got["a"]
    assert a.ups is None and a.downs is None and a.over_18 is None and a.title is None and a.num_comments == 0
    assert got["c"].over_18 is True and got["c"].ups == 7 and got["c"].num_comments == 4
    assert [r.post_id for r in rejected.collect()] == ["b"]


def comments_df(spark, rows):
    full = [tuple(r.get(f.name) for f in COMMENT_SNAPSHOT.fields) for r in rows]
    return spark.createDataFrame(full, COMMENT_SNAPSHOT)


def test_comment_ingest_restricts_to_top_posts(spark):
    stored = spark.createDataFrame(
        [("p1", "top"), ("p1", "top"), ("p2", "low")], "post_id string, subreddit string"
    )  # p1 stored twice (a re-run): comments must not double
    comms = communities_df(spark, [("top", 9.0), ("low", 1.0)])
    snaps = comments_df(
        spark,
        [
            dict(post_id="p1", comment_id="c1", author_name="x", score=0, created_utc=EPOCH_DAY + 5, edited="false"),
            dict(post_id="p1", comment_id="c2", author_name="y", score=3, created_utc=EPOCH_DAY - 5),
            dict(post_id="p2", comment_id="c3", author_name="z", score=1, created_utc=EPOCH_DAY + 5),
            dict(post_id="p1", comment_id="c4", author_name="w", created_utc=None),
        ],
    )
    out = ingest.ingest_comments(snaps, stored, comms, run_date=DAY, top_n=1).collect()
    assert [(r.comment_id, r.subreddit) for r in out] == [("c1", "top")]
    assert out[0].score is None and out[0].edited is None and out[0].etl_date == DAY
    # Backfill: every day, comments keep their own day; the one without time is rejected.
    acc, rej = ingest.ingest_comments(snaps, stored, comms, top_n=1, with_rejected=True)
    assert sorted(r.comment_id for r in acc.collect()) == ["c1", "c2"]
    assert [r.comment_id for r in rej.collect()] == ["c4"]


def test_salted_and_broadcast_joins_equal_plain(spark):
    big = spark.range(0, 5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.col("id"),
    )
    lookup = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 50, 2)], "k string, v int")
    plain = big.join(lookup, "k", "left")
    for how in ("left", "inner", "left_semi", "left_anti"):
        expect = big.join(lookup, "k", how)
        salted = joins.salted_join(big, lookup, ["k"], how, 8)
        assert salted.count() == expect.count()
        assert salted.exceptAll(expect).count() == 0
    via_lookup = joins.lookup_join(big, lookup, "k", "left", salt_buckets=4)
    assert via_lookup.exceptAll(plain).count() == 0 and plain.exceptAll(via_lookup).count() == 0


def test_reply_counts(spark):
    tree = spark.createDataFrame(
        [("p", "a", None), ("p", "b", "a"), ("p", "c", "a"), ("p", "d", "b"), ("q", "e", None)],
        "post_id string, comment_id string, parent_id string",
    )
    got = {r.comment_id: r.replies for r in counts.reply_counts(tree).collect()}
    assert got == {"a": 2, "b": 1, "c": None, "d": None, "e": None}


def test_flatten_nested_comment_tree(spark):
    schema = (
        "post_id string, comments array<struct<comment_id:string, author_name:string, "
        "replies:array<struct<comment_id:string, author_name:string, "
        "replies:array<struct<comment_id:string, author_name:string>>>>>>"
    )
    data = [
        (
            "p1",
            [
                ("a", "x", [("b", "y", [("c", "z")]), (None, None, [])]),  # a collapsed placeholder
                ("d", "w", []),
            ],
        ),
        ("p2", None),
    ]
    df = spark.createDataFrame(data, schema)
    flat = ingest.flatten_comment_tree(df)
    got = {(r.post_id, r.comment_id, r.parent_id, r.depth) for r in flat.collect()}
    assert got == {("p1", "a", None, 0), ("p1", "d", None, 0), ("p1", "b", "a", 1), ("p1", "c", "b", 2)}


def test_csv_communities(spark, tmp_dir):
    path = os.path.join(tmp_dir, "subs.csv")
    with open(path, "w") as fh:
        fh.write("subreddit_name,subscribers_count\nalpha,100\nbeta,NaN\ngamma,\ndelta,oops\nepsilon,250.5\n")
    df = files.read_communities_csv(spark, path)
    got = {r.subreddit_name: r.subscribers_count for r in df.collect()}
    assert got == {"alpha": 100.0, "beta": None, "gamma": None, "delta": None, "epsilon": 250.5}
    assert [r.subreddit_name for r in topn.top_communities(df, 2).collect()] == ["epsilon", "alpha"]


def test_json_snapshots_with_quarantine_and_partition_write(spark, tmp_dir):
    src = os.path.join(tmp_dir, "listing", "snapshot_date=2024-01-08")
    os.makedirs(src)
    with open(os.path.join(src, "part.json"), "w") as fh:
        fh.write(json.dumps(dict(subreddit="c", hot_rank=1, post_id="a", created=EPOCH_DAY + 1, author_id="u")) + "\n")
        fh.write("{not json\n")
        fh.write(json.dumps(dict(subreddit="c", hot_rank=2, post_id="b", created=EPOCH_DAY + 2, author_id="v")) + "\n")
    # Cached because the test *counts* the bad side (a count reads only the corrupt column).
    raw = files.read_post_snapshots(spark, os.path.join(tmp_dir, "listing")).cache()
    good, bad = files.split_corrupt(raw)
    assert bad.count() == 1
    comms = communities_df(spark, [("c", 1.0)])
    posts = ingest.ingest_posts(good, comms, run_date="2024-01-08")
    assert sorted(r.post_id for r in posts.collect()) == ["a", "b"]
    out = os.path.join(tmp_dir, "posts")
    write_partitioned(posts, out, mode="overwrite")
    write_partitioned(posts, out, mode="overwrite")  # a re-run replaces the day
    back = spark.read.parquet(out)
    assert back.count() == 2
    assert {r.subreddit for r in back.select("subreddit").collect()} == {"c"}


def test_read_exports_in_stored_layout(spark, tmp_dir):
    from agora.plans import staging
    from agora.sources import exports

    posts = os.path.join(tmp_dir, "posts")
    os.makedirs(posts)
    with open(os.path.join(posts, "a.json"), "w") as fh:
        fh.write(json.dumps({"submission_id": "abc", "submission.author_id": "t2_x", "submission_num_comments": 0,
                             "submission_over_18": True, "etl_ts": EPOCH_DAY + 5, "subreddit": "c"}) + "\n")
    p = exports.read_post_export(spark, posts).first()
    assert (p.post_id, p.author_id, p.num_comments, p.over_18, p.subreddit) == ("abc", "t2_x", 0, True, "c")
    assert p.title is None

    comments = os.path.join(tmp_dir, "comments")
    os.makedirs(comments)
    with open(os.path.join(comments, "a.json"), "w") as fh:
        for cid, user in (("k1", "alice"), ("k2", None)):
            fh.write(json.dumps({"author_id": cid, "author_author": user, "author_score": 3,
                                 "author_created_utc": EPOCH_DAY + 60, "etl_ts": EPOCH_DAY + 90,
                                 "subreddit": "c"}) + "\n")
    c = exports.read_comment_export(spark, comments)
    assert sorted((r.comment_id, r.author_name) for r in c.collect()) == [("k1", "alice"), ("k2", None)]
    # Staging straight from an export: parity keys on the comment id, intent on the user.
    parity = staging.stage_users(c, "2024-01-08", user_col="comment_id").collect()
    intent = staging.stage_users(c, "2024-01-08").collect()
    assert sorted(r.author_id for r in parity) == ["k1", "k2"]
    assert sorted(r.author_id for r in intent) == ["None", "alice"]


def test_communities_csv_is_read_by_header_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "c.csv")
    with open(path, "w") as fh:
        fh.write("id,subscribers_count,subreddit_name\n1,10,a\n2,,b\n3,x,c\n")
    got = {(r.subreddit_name, r.subscribers_count) for r in files.read_communities_csv(spark, path).collect()}
    assert got == {("a", 10.0), ("b", None), ("c", None)}
    bad = os.path.join(tmp_dir, "bad.csv")
    with open(bad, "w") as fh:
        fh.write("id,subreddit_name\n1,a\n")
    with pytest.raises(ValueError, match="subscribers_count"):
        files.read_communities_csv(spark, bad)


def test_comment_tree_of_any_depth_keeps_reply_counts(spark):
    tree = "array<struct<comment_id:string,score:int,replies:array<struct<comment_id:string,score:int,replies:array<struct<comment_id:string,score:int>>>>>>"
    rows = [("p", [("a", 1, [("b", 2, [("c", 3), ("d", 4)]), (None, 0, [("e", 5)])]), ("f", 6, None)]), ("q", None), ("r", [])]
    flat = ingest.flatten_comment_tree(spark.createDataFrame(rows, f"post_id string, comments {tree}"))
    got = {(r.comment_id, r.parent_id, r.depth, r.reply_count, r.score) for r in flat.collect()}
    assert got == {
        ("a", None, 0, 2, 1), ("b", "a", 1, 2, 2), ("c", "b", 2, None, 3), ("d", "b", 2, None, 4), ("e", None, 2, None, 5),
        ("f", None, 0, None, 6),
    }
    assert flat._jdf.queryExecution().executedPlan().toString().count("Generate") == 1

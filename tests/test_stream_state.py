"""Streams: flags read per batch, de-duplication that survives bad clocks."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from agora.schemas import POST_EVENT
from agora.streaming import content_flag


def land(path, name, events):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f".{name}"), "w") as fh:
        for e in events:
            fh.write(json.dumps(e) + "\n")
    os.rename(os.path.join(path, f".{name}"), os.path.join(path, name))


def event(thread, time_text=None, subreddit="c"):
    return dict(subreddit=subreddit, thread_id=thread, author_id="u", creation_date=time_text, url=None, is_violation=None)


def stream(spark, path):
    return content_flag.good_events(content_flag.parse_events(content_flag.read_event_values(spark, "json", path, max_files_per_trigger=1)))


def posts(spark, path, rows):
    spark.createDataFrame(rows, "post_id string, over_18 boolean").write.mode("overwrite").parquet(path)


def communities(spark, path, rows):
    spark.createDataFrame(rows, "subreddit string, community_adult boolean").write.mode("overwrite").parquet(path)


def test_flag_added_mid_stream_is_seen(spark, tmp_dir):
    d = lambda *p: os.path.join(tmp_dir, *p)
    posts(spark, d("posts"), [("a", True), ("x", True)])
    communities(spark, d("flags"), [("other", True)])
    land(d("in"), "1.json", [event("a"), event("b")])

    query = content_flag.start_current_flags(
        stream(spark, d("in")), content_flag.stored_lookups(d("posts"), d("flags")), "json", d("ckpt"), path=d("out"),
        processing_time="100 milliseconds",
    )
    try:
        query.processAllAvailable()
        # both folders are replaced while the stream runs
        posts(spark, d("posts"), [("a", True), ("b", True), ("c", True), ("e", False)])
        communities(spark, d("flags"), [("nsfw", True)])
        land(d("in"), "2.json", [event("b"), event("c", subreddit="nsfw"), event("e"), event("x")])
        query.processAllAvailable()
        assert query.isActive and query.exception() is None
    finally:
        query.stop()
    got = [(r.thread_id, r.is_violation) for r in content_flag.read_flagged(spark, d("out")).collect()]
    assert sorted(got, key=str) == sorted([("a", True), ("b", None), ("b", True), ("c", False), ("e", False), ("x", None)], key=str)


def test_batch_run_again_is_there_once(spark, tmp_dir):
    """A driver lost after the write and before the commit: the batch replaces itself."""
    d = lambda *p: os.path.join(tmp_dir, *p)
    posts(spark, d("posts"), [("a", True)])
    communities(spark, d("flags"), [("c", False)])
    land(d("in"), "1.json", [event("a"), event("b")])
    lookups = content_flag.stored_lookups(d("posts"), d("flags"))

    def run():
        q = content_flag.start_current_flags(stream(spark, d("in")), lookups, "parquet", d("ckpt"), path=d("out"), available_now=True)
        q.awaitTermination()

    run()
    commits = [f for f in os.listdir(d("ckpt", "commits")) if "0" in f]
    assert commits
    os.makedirs(d("lost"))
    for f in commits:
        os.rename(d("ckpt", "commits", f), d("lost", f))
    run()
    got = sorted((r.thread_id, r.is_violation) for r in content_flag.read_flagged(spark, d("out"), "parquet").collect() if r.is_violation is not None)
    assert got == [("a", True)] and content_flag.read_flagged(spark, d("out"), "parquet").count() == 2


def test_replaced_file_costs_another_attempt(spark, tmp_dir, monkeypatch):
    d = lambda *p: os.path.join(tmp_dir, *p)
    monkeypatch.setattr(content_flag, "LOOKUP_WAIT_S", 0.0)
    posts(spark, d("posts"), [("a", True)])
    communities(spark, d("flags"), [])
    land(d("in"), "1.json", [event("a")])
    real, calls = content_flag.stored_lookups(d("posts"), d("flags")), []

    def vanishing(session, batch):
        calls.append(1)
        if len(calls) == 1:  # listed, then replaced before it is read
            stale = session.read.schema(content_flag.LOOKUP_POSTS).parquet(d("posts"))
            stale.inputFiles()
            posts(session, d("posts"), [("a", False)])
            return stale.select(F.col("post_id").alias("thread_id"), F.col("over_18").alias("post_adult")), real(session, batch)[1]
        return real(session, batch)

    q = content_flag.start_current_flags(stream(spark, d("in")), vanishing, "json", d("ckpt"), path=d("out"), available_now=True)
    q.awaitTermination()
    assert len(calls) == 2
    assert [(r.thread_id, r.is_violation) for r in content_flag.read_flagged(spark, d("out")).collect()] == [("a", False)]


def test_other_failures_end_the_stream(spark, tmp_dir):
    d = lambda *p: os.path.join(tmp_dir, *p)
    land(d("in"), "1.json", [event("a")])

    def broken(session, batch):
        raise RuntimeError("no such thing")

    q = content_flag.start_current_flags(stream(spark, d("in")), broken, "json", d("ckpt"), path=d("out"), available_now=True)
    with pytest.raises(Exception, match="no such thing"):
        content_flag.await_all([q])


def deduped(spark, d, batches, name):
    for k, events in enumerate(batches):
        land(d("in"), f"{k}.json", events)
        time.sleep(0.05)
    out = content_flag.dedupe_events(stream(spark, d("in")))
    q = out.writeStream.format("parquet").option("path", d("out")).option("checkpointLocation", d("ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    return [r.thread_id for r in spark.read.schema(POST_EVENT).parquet(d("out")).collect()]


@pytest.mark.parametrize("far", ["1e12", "1e300", "inf", "nan", "-1e300"])
def test_one_bad_clock_costs_no_other_event(spark, tmp_dir, far):
    d = lambda *p: os.path.join(tmp_dir, *p)
    now = f"{time.time():.1f}"
    got = deduped(spark, d, [
        [event("1", now), event("2", far), event("2", far)],
        [event("3", now), event("1", now), event("4", "1704672000.0"), event("4", "1704672000.0")],
        [event("5", now), event("6", None), event("6", "not a time"), event("2", now)],
        [event("7", now), event("6"), event("4", now)],
    ], "bad")
    assert sorted(got) == ["1", "2", "3", "4", "5", "6", "7"]


def test_events_without_a_thread_stay_apart(spark, tmp_dir):
    d = lambda *p: os.path.join(tmp_dir, *p)
    got = deduped(spark, d, [[event(None, "1"), event(None, "2")], [event(None, "1"), event(None, "1", "other")]], "none")
    assert got == [None] * 3


def test_delay_must_hold_the_clock_bounds(spark, tmp_dir):
    events = stream(spark, tmp_dir)
    with pytest.raises(ValueError):
        content_flag.dedupe_events(events, "10 minutes")
    assert content_flag.dedupe_events(events, "35 minutes").isStreaming

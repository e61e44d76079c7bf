"""Staging load (re-runnable), stream twin of the content flag, dedup, config."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from agora.plans import moderation, staging
from agora.schemas import declared_schema, load_declared_schema
from agora.sources import files, standins
from agora.streaming import content_flag
from tests.conftest import SF_SMALL

EPOCH_DAY = 1704672000.0  # 2024-01-08 00:00:00 UTC


def comments(spark, rows):
    return spark.createDataFrame(rows, "author_name string, created_utc double, etl_ts double")


def test_day_window_is_half_open(spark):
    rows = [
        ("a", EPOCH_DAY - 0.000001, EPOCH_DAY),
        ("b", EPOCH_DAY, EPOCH_DAY),
        ("c", EPOCH_DAY + 86399.999999, EPOCH_DAY),
        ("d", EPOCH_DAY + 86400, EPOCH_DAY),
        (None, EPOCH_DAY + 5, EPOCH_DAY + 5),
    ]
    out = staging.stage_users(comments(spark, rows), "2024-01-08").collect()
    assert sorted((r.author_id, r.etl_ts) for r in out) == [
        ("None", dt.date(2024, 1, 8)),
        ("b", dt.date(2024, 1, 8)),
        ("c", dt.date(2024, 1, 8)),
    ]


def test_reloading_a_day_leaves_staging_unchanged(spark, tmp_dir):
    path = os.path.join(tmp_dir, "stg")
    day1 = comments(spark, [("a", EPOCH_DAY + 1, EPOCH_DAY + 1), ("b", EPOCH_DAY + 2, EPOCH_DAY + 2)])
    day2 = comments(spark, [("c", EPOCH_DAY + 86401, EPOCH_DAY + 86401)])
    load = lambda rows, day: staging.write_staging(staging.stage_users(rows, day), path, day)
    load(day1, "2024-01-08")
    load(day2, "2024-01-09")
    read = lambda: sorted((r.author_id, r.etl_ts) for r in spark.read.parquet(path).collect())
    before = read()
    load(day1, "2024-01-08")
    assert before == read() and len(before) == 3


def test_runs_that_share_a_load_day_keep_all_rows(spark, tmp_dir):
    path, bad = os.path.join(tmp_dir, "stg"), os.path.join(tmp_dir, "bad")
    late = EPOCH_DAY + 86400 + 5  # loaded after midnight
    rows = comments(spark, [("a", EPOCH_DAY + 1, late), ("b", late, late), ("c", EPOCH_DAY + 2, None)])
    table = f"late_{os.path.basename(tmp_dir).replace('-', '_')}"
    for day in ("2024-01-08", "2024-01-09", "2024-01-08"):
        staged = staging.stage_users(rows, day)
        staging.write_staging(staged, path, day, bad)
        staging.write_staging_table(staged, table, 2, path=os.path.join(tmp_dir, "table"))
    assert sorted(r.author_id for r in spark.read.parquet(path).collect()) == ["a", "b"]
    assert sorted(r.author_id for r in spark.table(table).collect()) == ["a", "b"]
    assert [r.author_id for r in spark.read.parquet(bad).collect()] == ["c"]


def test_missing_stream_value_is_no_event(spark):
    parsed = content_flag.parse_events(spark.createDataFrame([(None,), ("{}",)], "value string"))
    assert content_flag.good_events(parsed).count() == 1
    assert [r[0] for r in content_flag.bad_events(parsed).collect()] == ["null"]


def write_events(dirname, events, name):
    os.makedirs(dirname, exist_ok=True)
    with open(os.path.join(dirname, name), "w") as fh:
        for e in events:
            fh.write(e if isinstance(e, str) else json.dumps(e))
            fh.write("\n")


def test_stream_twin_equals_batch(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source")
    events = standins.post_events_from_documents(docs)
    rows = [r.asDict() for r in events.collect()]
    src = os.path.join(tmp_dir, "in")
    write_events(src, rows[: len(rows) // 2], "a.json")
    write_events(src, rows[len(rows) // 2 :] + ["{broken"], "b.json")
    post_flags = standins.post_flags(spark, SF_SMALL)
    comm_flags = standins.community_flags(spark, SF_SMALL)

    parsed = content_flag.parse_events(content_flag.read_event_values(spark, "json", src, max_files_per_trigger=1))
    flagged = content_flag.flag_events(
        content_flag.good_events(parsed), post_flags, comm_flags, salt_buckets=4
    )
    out = os.path.join(tmp_dir, "out")
    q = content_flag.start_sink(flagged, "json", os.path.join(tmp_dir, "ckpt"), path=out, available_now=True)
    q.awaitTermination()
    assert q.lastProgress is not None
    streamed = spark.read.schema(flagged.schema).json(out)
    batch = moderation.apply_content_flag(events, post_flags, comm_flags)
    assert streamed.count() == batch.count() == len(rows)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_dedup_within_watermark(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    base = dict(subreddit="s", author_id="u", url=None, is_violation=None)
    write_events(
        src,
        [
            dict(base, thread_id="t1", creation_date="1704672000.0"),
            dict(base, thread_id="t1", creation_date="1704672060.0"),  # repeat within the delay
            dict(base, thread_id="t2", creation_date="1704672000.0"),
            dict(base, thread_id="t3", creation_date=None),  # no event time: passes
        ],
        "a.json",
    )
    parsed = content_flag.good_events(content_flag.parse_events(content_flag.read_event_values(spark, "json", src)))
    deduped = content_flag.dedupe_events(parsed, "1 hour")
    q = (
        deduped.writeStream.format("memory").queryName("dedup_out")
        .option("checkpointLocation", os.path.join(tmp_dir, "ckpt"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = sorted(r.thread_id for r in spark.sql("SELECT thread_id FROM dedup_out").collect())
    assert got == ["t1", "t2", "t3"]


def test_kafka_sink_and_source_need_connector(spark):
    # The connector jar is not part of this image: building the source fails cleanly.
    with pytest.raises(Exception):
        content_flag.read_event_values(spark, "kafka", options={"kafka.bootstrap.servers": "localhost:1", "subscribe": "t"})


def test_declared_schema_from_yaml(tmp_dir):
    path = os.path.join(tmp_dir, "posts.yaml")
    with open(path, "w") as fh:
        fh.write("- name: title\n  type: VARCHAR\n- name: created_ts\n  type: float\n"
                 "- name: num_comments\n  type: int\n- name: over_18\n  type: bool\n")
    schema = load_declared_schema(path)
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [
        ("title", "string"), ("created_ts", "double"), ("num_comments", "bigint"), ("over_18", "boolean"),
    ]
    with pytest.raises(ValueError):
        declared_schema([{"name": "x", "type": "blob"}])


def test_connection_options_from_conf(spark, monkeypatch):
    spark.conf.set("spark.agora.jdbc.reporting.url", "jdbc:postgresql://db/reporting")
    monkeypatch.setenv("AGORA_JDBC_REPORTING_USER", "loader")
    opts = files.connection_options(spark, "reporting")
    assert opts == {"url": "jdbc:postgresql://db/reporting", "user": "loader"}
    with pytest.raises(KeyError):
        files.connection_options(spark, "missing-profile")


def test_community_flags_are_a_share(spark):
    flags = {r.subreddit: r.community_adult for r in standins.community_flags(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    sums = docs.join(labels, "doc_id").groupBy("source").agg(F.sum("toxic").alias("s"), F.count("toxic").alias("n")).collect()
    assert flags == {r.source: (r.s + 1) / (r.n + 10) >= 0.15 for r in sums}


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_content_flag_has_every_value_at_every_size(spark, sf):
    from agora.plans import catalog

    flagged = catalog.QUERIES["content_flag_batch"](spark, f"/root/testdata/sf{sf}")
    assert {r[0] for r in flagged.select("is_violation").distinct().collect()} == {True, False, None}


def test_jobs_end_to_end(spark, tmp_dir):
    """ingest-posts -> ingest-comments -> stage-users -> report, through the CLI."""
    from agora import jobs

    def jl(path, rows):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            for r in rows:
                fh.write(json.dumps(r) + "\n")

    subs = os.path.join(tmp_dir, "subs.csv")
    with open(subs, "w") as fh:
        fh.write("subreddit_name,subscribers_count\nbig,100\nsmall,5\n")
    jl(os.path.join(tmp_dir, "listing", "snapshot_date=2024-01-08", "a.json"), [
        dict(subreddit="big", hot_rank=1, post_id="p1", created=EPOCH_DAY + 60, author_id="u1", over_18=True),
        dict(subreddit="big", hot_rank=2, post_id="p2", created=EPOCH_DAY - 60, author_id="u2"),
        dict(subreddit="small", hot_rank=1, post_id="p3", created=EPOCH_DAY + 60, author_id="u3"),
    ])
    jl(os.path.join(tmp_dir, "comments_in", "a.json"), [
        dict(post_id="p1", comment_id="c1", author_name="alice", score=2, created_utc=EPOCH_DAY + 100),
        dict(post_id="p1", comment_id="c2", author_name="bob", score=0, created_utc=EPOCH_DAY + 200),
        dict(post_id="p3", comment_id="c3", author_name="carol", score=1, created_utc=EPOCH_DAY + 300),
    ])
    d = lambda *p: os.path.join(tmp_dir, *p)
    jobs.main(["ingest-posts", "--communities", subs, "--snapshots", d("listing"), "--out", d("posts"),
               "--run-date", "2024-01-08", "--top-n", "1", "--quarantine", d("q")])
    jobs.main(["ingest-comments", "--comments", d("comments_in"), "--posts", d("posts"), "--communities", subs,
               "--out", d("comments"), "--run-date", "2024-01-08", "--top-n", "1"])
    jobs.main(["stage-users", "--comments", d("comments"), "--out", d("stg"), "--run-date", "2024-01-08"])
    jobs.main(["report", "active_days", "--staging", d("stg"), "--out", d("rep")])
    jobs.main(["report", "all", "--staging", d("stg"), "--out", d("all")])
    for name in ("active_days", "activity_rate", "consecutive_days"):
        assert spark.read.parquet(d("all", name)).count() == 2
    shared = {r.author_id: r.user_num_active_in_week for r in spark.read.parquet(d("all", "active_days")).collect()}
    assert shared == {"alice": 1, "bob": 1}
    posts = spark.read.parquet(d("posts"))
    assert sorted(r.post_id for r in posts.collect()) == ["p1"]
    assert sorted(r.comment_id for r in spark.read.parquet(d("comments")).collect()) == ["c1", "c2"]
    rep = {r.author_id: r.user_num_active_in_week for r in spark.read.parquet(d("rep")).collect()}
    assert rep == {"alice": 1, "bob": 1}
    flags = {r.thread_id: r.post_adult for r in moderation.post_flags_from_posts(posts).collect()}
    assert flags == {"p1": True}


def test_week_filter_prunes_day_partitions(spark, tmp_dir):
    """On a day-partitioned staging table the parity week filter prunes partitions."""
    from agora.plans import weekly

    path = os.path.join(tmp_dir, "stg")
    rows = [("a", EPOCH_DAY + 86400 * d, EPOCH_DAY + 86400 * d) for d in range(-10, 20)]
    staging.write_staging(staging.stage_users(comments(spark, rows)), path, "all")
    df = weekly.weekly_active_days(spark.read.parquet(path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(etl_ts" in plan and "weekofyear(etl_ts" in plan
    assert {(r.author_id, r.user_num_active_in_week) for r in df.collect()} == {("a", 7)}


def test_stored_posts_schema_evolution(spark, tmp_dir):
    path = os.path.join(tmp_dir, "posts")
    old = spark.createDataFrame([("p1", "c", dt.date(2024, 1, 7))], "post_id string, subreddit string, etl_date date")
    new = spark.createDataFrame(
        [("p2", True, "c", dt.date(2024, 1, 8))], "post_id string, over_18 boolean, subreddit string, etl_date date"
    )
    from agora.sinks.batch import write_partitioned

    write_partitioned(old, path, mode="append")
    write_partitioned(new, path, mode="append")
    got = {r.post_id: r.over_18 for r in files.read_stored(spark, path).collect()}
    assert got == {"p1": None, "p2": True}


def test_bucketed_staging_table_reports_without_exchange(spark, tmp_dir):
    """Reports on the bucketed (author) staging table plan no exchange and match the raw staging."""
    import re

    from agora.plans import weekly

    raw = staging.stage_users(standins.stored_comments(spark, SF_SMALL))
    table = f"stg_{os.path.basename(tmp_dir).replace('-', '_')}"
    staging.write_staging_table(raw, table, 4, path=os.path.join(tmp_dir, "stg"))
    t = spark.table(table)
    for build in (weekly.weekly_active_days, weekly.consecutive_day_flags, weekly.longest_streak):
        on_table = build(t)
        assert len(re.findall("Exchange hashpartitioning", on_table._jdf.queryExecution().executedPlan().toString())) == 0
        assert on_table.exceptAll(build(raw)).count() == 0 and build(raw).exceptAll(on_table).count() == 0
    # One row per (author, day); a reload of one day leaves the table unchanged.
    n = t.count()
    assert n == raw.select("author_id", "etl_ts").distinct().count()
    day = staging.stage_users(standins.stored_comments(spark, SF_SMALL, "2024-01-08"), "2024-01-08")
    staging.write_staging_table(day, table, 4)
    assert spark.table(table).count() == n


def test_flag_stream_job(spark, tmp_dir):
    """flag-stream CLI: JSON events in, stored posts and community flags as lookups, JSON out."""
    from agora import jobs

    d = lambda *p: os.path.join(tmp_dir, *p)
    spark.createDataFrame(
        [("p1", True, "c1"), ("p2", None, "c1"), ("p3", True, "c2")], "post_id string, over_18 boolean, subreddit string"
    ).write.parquet(d("posts"))
    spark.createDataFrame([("c2", True)], "subreddit string, community_adult boolean").write.parquet(d("cflags"))
    base = dict(author_id="u", url=None, is_violation=False)
    write_events(d("in"), [
        dict(base, subreddit="c1", thread_id="p1", creation_date="1704672000.0"),  # adult post, safe community
        dict(base, subreddit="c1", thread_id="p1", creation_date="1704672030.0"),  # repeat: deduped
        dict(base, subreddit="c1", thread_id="p2", creation_date="1704672000.0"),  # stored, not adult
        dict(base, subreddit="c2", thread_id="p3", creation_date="1704672000.0"),  # adult community
        dict(base, subreddit="c9", thread_id="p9", creation_date="1704672000.0"),  # unknown post
        "not json",
    ], "a.json")
    jobs.main([
        "flag-stream", "--source", "json", "--input", d("in"), "--posts", d("posts"),
        "--community-flags", d("cflags"), "--sink", "json", "--output", d("out"),
        "--checkpoint", d("ckpt"), "--available-now", "--dedupe", "1 hour", "--quarantine", d("bad"),
    ])
    bad = [json.loads(r.value) for r in spark.read.text(d("bad", "data")).collect()]
    assert bad == [{"_corrupt_record": "not json"}]
    from agora.schemas import POST_EVENT

    got = {r.thread_id: r.is_violation for r in spark.read.schema(POST_EVENT).json(d("out")).collect()}
    assert got == {"p1": True, "p2": False, "p3": False, "p9": None}


def test_parquet_file_stream_source(spark, tmp_dir):
    """Landed Parquet files as the event stream (the documents table read as a file stream)."""
    events = content_flag.document_event_stream(spark, SF_SMALL)
    assert events.isStreaming
    q = (
        events.writeStream.format("memory").queryName("doc_events")
        .option("checkpointLocation", os.path.join(tmp_dir, "ckpt"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    n = spark.sql("SELECT count(*) AS n FROM doc_events").first().n
    assert n == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_landed_snapshots_through_the_job(spark, tmp_dir):
    """Stand-in listings landed as partitioned JSON, ingested by the CLI job, equal the registered query."""
    from agora import jobs
    from agora.plans import catalog, ingest

    d = lambda *p: os.path.join(tmp_dir, *p)
    snaps = standins.post_snapshots(spark, SF_SMALL)
    # Land the listing as the snapshot folders a crawler would write (hot rank = stand-in hot order).
    from pyspark.sql import Window

    ranked = snaps.withColumn(
        "hot_rank",
        F.row_number().over(Window.partitionBy("snapshot_date", "subreddit").orderBy(*standins.standin_hot_order())),
    )
    ranked.coalesce(1).write.partitionBy("snapshot_date", "subreddit").json(d("landing"))
    standins.communities(spark, SF_SMALL).coalesce(1).write.option("header", "true").csv(d("subs"))

    days = sorted(r[0] for r in catalog.QUERIES["posts_ingest"](spark, SF_SMALL).select("etl_date").distinct().collect())
    for day in days[:3]:
        jobs.main(["ingest-posts", "--communities", d("subs"), "--snapshots", d("landing"),
                   "--out", d("posts"), "--run-date", day.isoformat()])
    landed = spark.read.parquet(d("posts"))
    expect = catalog.QUERIES["posts_ingest"](spark, SF_SMALL).where(F.col("etl_date").isin(days[:3]))
    cols = ["post_id", "subreddit", "etl_date", "created", "ups", "over_18", "author_id", "num_comments"]
    assert sorted(map(tuple, landed.select(*cols).collect())) == sorted(map(tuple, expect.select(*cols).collect()))
    assert landed.count() > 0

    # On the landed layout the daily run prunes both day and community folders.
    plan = ingest.ingest_posts(
        files.read_post_snapshots(spark, d("landing")), files.read_communities_csv(spark, d("subs")), days[0]
    )._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan json" in line)
    filters = scan[scan.index("PartitionFilters: [") : scan.index(", PushedFilters")]
    assert "snapshot_date" in filters and "subreddit" in filters and "INSET" in filters, filters

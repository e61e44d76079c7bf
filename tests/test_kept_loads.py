"""Ranks by ranges, calendar pruning, published runs, and summaries that loads add to."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from agora.operators import calendar, ranking, topn
from agora.operators.activity import week_masks
from agora.plans import ingest, staging, user_days, weekly
from agora.sinks import published

STG = "author_id string, etl_ts date"
D = dt.date


def stg(spark, rows):
    return spark.createDataFrame(rows, STG)


# ---------- ranking


@pytest.fixture()
def listing(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("community"),
        ((F.col("id") * 7919) % 5000).alias("ups"), F.col("id").cast("string").alias("post_id"),
    )
    return rows.withColumn("community", F.when(F.col("community") == "c7", None).otherwise(F.col("community")))


def python_ranks(rows, n):
    groups = {}
    for r in rows:
        groups.setdefault(r.community, []).append((-r.ups, r.post_id))
    return {(g, p, k) for g, items in groups.items() for k, (_, p) in enumerate(sorted(items), 1) if n is None or k <= n}


@pytest.mark.parametrize("n", [1001, 3000, None])
def test_ranks_equal_row_number(spark, listing, n):
    order = [F.col("ups").desc(), F.col("post_id").asc()]
    got = ranking.ranked(listing, ["community"], order, "rank", n, ranges=16)
    assert {(r.community, r.post_id, r.rank) for r in got.collect()} == python_ranks(listing.collect(), n)
    assert got.columns == [*listing.columns, "rank"]


def test_hot_group_spreads_over_ranges(spark, listing):
    rows = ranking.dealt(listing, ["community"], [F.col("ups").desc()], 16)
    sizes = [r["count"] for r in rows.groupBy("_range").count().collect()]
    assert len(sizes) >= 14 and max(sizes) < 3 * 20_000 / 16
    # all rows of one order: ties and repeated rows spread as well
    same = listing.select(F.lit("g").alias("community"), F.lit(1).alias("ups"))
    sizes = [r["count"] for r in ranking.dealt(same, ["community"], ["ups"], 16).groupBy("_range").count().collect()]
    assert len(sizes) >= 14 and max(sizes) < 3 * 20_000 / 16
    ranks = sorted(r.rank for r in ranking.ranked(same, ["community"], ["ups"], "rank", 1500, ranges=16).collect())
    assert ranks == list(range(1, 1501))


def test_long_listing_never_meets_in_one_task(spark, listing):
    """The largest task that reads a shuffle gets a range's share, not the hot group."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = topn.first_n_per_group(listing, ["community"], [F.col("ups").desc(), F.col("post_id")], 9000, "r")
        per_task = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert per_task <= 3000  # 19,000 rows, 9,000 of them of one group
    assert got.where("community = 'hot'").count() == 9000 and dict(got.dtypes)["r"] == "int"


def test_numbers_are_dense(spark):
    df = spark.createDataFrame([(x,) for x in "dbca"], "x string")
    assert sorted((r.x, r.n) for r in ranking.numbered(df, ["x"], "n", 3).collect()) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    assert ranking.numbered(df.limit(0), ["x"], "n").collect() == []


# ---------- published runs (K3)


def test_killed_load_is_invisible(spark, tmp_dir):
    a, b = stg(spark, [("a", D(2024, 1, 8)), ("x", None)]), stg(spark, [("b", D(2024, 1, 9))])
    staging.publish_staging(a, tmp_dir, "2024-01-08", "2024-01-09")
    # killed after its rows were written: the audit stands for the place where it dies
    with pytest.raises(RuntimeError):
        staging.publish_staging(b, tmp_dir, "2024-01-09", "2024-01-10", audit=lambda rows: (_ for _ in ()).throw(RuntimeError(str(rows))))
    assert os.path.isdir(os.path.join(tmp_dir, "rows", "run=2024-01-09_2024-01-10"))
    assert [r.author_id for r in staging.read_staging(spark, tmp_dir).collect()] == ["a"]
    assert [tuple(r) for r in staging.read_staging(spark, tmp_dir, "rejects").collect()] == [("x", None)]
    staging.publish_staging(b, tmp_dir, "2024-01-09", "2024-01-10")
    assert sorted(r.author_id for r in staging.read_staging(spark, tmp_dir).collect()) == ["a", "b"]


def test_failing_write_is_invisible(spark, tmp_dir):
    bad = stg(spark, [("a", D(2024, 1, 8))]).withColumn("author_id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        staging.publish_staging(bad, tmp_dir, "2024-01-08", "2024-01-09")
    assert staging.read_staging(spark, tmp_dir).collect() == [] and published.entries(spark, tmp_dir) == []


def test_backfill_takes_the_place_of_its_days(spark, tmp_dir):
    for day in (8, 9, 20):
        staging.publish_staging(stg(spark, [(f"daily{day}", D(2024, 1, day))]), tmp_dir, D(2024, 1, day), D(2024, 1, day + 1))
    staging.publish_staging(stg(spark, [("again9", D(2024, 1, 9))]), tmp_dir, "2024-01-09", "2024-01-10")  # a repeated run
    names = lambda: sorted(r.author_id for r in staging.read_staging(spark, tmp_dir).collect())
    assert names() == ["again9", "daily20", "daily8"]
    staging.publish_staging(stg(spark, [("all", D(2024, 1, 8)), ("all", D(2024, 1, 9))]), tmp_dir, "2024-01-08", "2024-01-15")
    assert names() == ["all", "all", "daily20"]
    with pytest.raises(ValueError, match="covers part of"):
        staging.publish_staging(stg(spark, [("late", D(2024, 1, 9))]), tmp_dir, "2024-01-09", "2024-01-10")
    assert [e.rows for e in published.live(published.entries(spark, tmp_dir)) if e.end == "2024-01-15"] == [{"rows": 2, "rejects": 0}]
    # only runs of the asked days are listed
    found = published.read_published(spark, tmp_dir, "rows", STG, ("2024-01-20", "2024-01-21"))
    assert [r.author_id for r in found.collect()] == ["daily20"]


# ---------- calendar


def scanned_partitions(df):
    df.collect()
    found = []

    def visit(node):
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node.metrics().apply("numPartitions").value())
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return visit(node.plan())
        for k in range(node.children().size()):
            visit(node.children().apply(k))

    visit(df._jdf.queryExecution().executedPlan())
    return found


def test_calendar_prunes_day_folders(spark, tmp_dir):
    rows = [(a, D(2023, 1, 1) + dt.timedelta(d)) for d in range(0, 500, 1) for a in ("u", "None")] + [("old", D(2023, 1, 10)), ("w", D(2024, 1, 14))]
    staging.publish_staging(stg(spark, rows), tmp_dir, "2023-01-01", "2024-12-31")
    stored = staging.read_staging(spark, tmp_dir)
    one = calendar.week_masks_of_days(stored, every_year=False)
    assert "dynamicpruning" in one._jdf.queryExecution().executedPlan().toString()
    assert scanned_partitions(one) == [7]
    every = calendar.week_masks_of_days(stored)
    assert scanned_partitions(every) == [14]
    as_set = lambda df: {(r.author_id, r.mask) for r in df.collect()}
    assert as_set(every) == as_set(week_masks(stored)) == {("u", 127), ("w", 64), ("old", 0)}
    assert as_set(one) == as_set(week_masks(stored, prune=True)) == {("u", 127), ("w", 64)}


def test_calendar_weeks(spark):
    days = {r.day: r for r in calendar.calendar(spark, D(2020, 12, 1), D(2021, 1, 31)).collect()}
    for day, r in days.items():
        _, week, weekday = day.isocalendar()
        assert (r.iso_week, r.bit, r.week_start) == (week, 1 << (weekday - 1), day - dt.timedelta(weekday - 1))


# ---------- masks, bitmaps and runs


def test_masks_equal_a_recompute_after_each_day(spark, tmp_dir):
    rng, held = random.Random(3), []
    for day in (8, 9, 10, 9, 15, 14):  # a repeated day, another week, a day out of order
        load = [(rng.choice(["a", "b", "c", "None"]), D(2024, 1, day)) for _ in range(4)] + [("z", None)]
        held += load
        user_days.add_to_week_masks(stg(spark, load), tmp_dir)
        if day == 10:
            user_days.add_to_week_masks(stg(spark, load), tmp_dir)
        for monday in (D(2024, 1, 8), D(2024, 1, 15)):
            got = {(r.author_id, r.mask) for r in user_days.week_masks(spark, tmp_dir, monday).collect()}
            _, week, _ = monday.isocalendar()
            assert got == {(r.author_id, r.mask) for r in week_masks(stg(spark, held), 2024, week, prune=True).collect()}
    flags = weekly.consecutive_day_flags(masks=user_days.week_masks(spark, tmp_dir, D(2024, 1, 8)))
    assert flags.exceptAll(weekly.consecutive_day_flags(stg(spark, held), prune=True)).count() == 0


def test_spans_equal_a_distinct_count(spark, tmp_dir):
    rng, held = random.Random(4), []
    for first in (1, 8, 15, 8):  # the second week is loaded again
        end = D(2024, 1, first + 7)
        load = [(f"u{rng.randrange(40)}", D(2024, 1, first) + dt.timedelta(rng.randrange(7))) for _ in range(60)] + [("None", D(2024, 1, first)), ("q", None)]
        held = [r for r in held if not (r[1] and D(2024, 1, first) <= r[1] < end)] + load
        users = user_days.number_new_users(stg(spark, load), os.path.join(tmp_dir, "users"), f"{first}")
        user_days.add_bitmaps(stg(spark, load), users, os.path.join(tmp_dir, "days"), f"2024-01-{first:02d}", end.isoformat())
    numbers = sorted(r.user_no for r in users.collect())
    assert numbers == list(range(1, len(numbers) + 1)) and len(numbers) == len({a for a, d in held if d and a != "None"} | {r.author_id for r in users.collect()})
    seen = [(a, d) for a, d in held if d and a != "None"]
    want = {
        (day, *(len({a for a, d in seen if day - dt.timedelta(s) < d <= day}) for s in (1, 7, 28))) for day in {d for _, d in seen}
    }
    got = user_days.active_users(user_days.day_bitmaps(spark, os.path.join(tmp_dir, "days")))
    assert {tuple(r) for r in got.collect()} == want
    with pytest.raises(ValueError, match="outside"):
        user_days.add_bitmaps(stg(spark, [("a", D(2024, 3, 1))]), users, tmp_dir, "2024-01-01", "2024-01-02")


def test_bitmaps_beyond_one_bucket(spark, tmp_dir):
    rows = spark.range(70_000).select(F.concat(F.lit("u"), "id").alias("author_id"), F.lit("2024-01-08").cast("date").alias("etl_ts"))
    users = user_days.number_new_users(rows, os.path.join(tmp_dir, "users"), "one")
    user_days.add_bitmaps(rows, users, os.path.join(tmp_dir, "days"), "2024-01-08", "2024-01-09")
    maps = user_days.day_bitmaps(spark, os.path.join(tmp_dir, "days"))
    assert maps.count() == 3
    assert [tuple(r) for r in user_days.active_users(maps, (1,)).collect()] == [(D(2024, 1, 8), 70_000)]


def python_streak(days):
    best = run = 0
    for d in sorted(days):
        run = run + 1 if d - dt.timedelta(1) in days else 1
        best = max(best, run)
    return best


def test_run_summaries_merge_in_any_grouping(spark):
    rng = random.Random(6)
    rows = [(f"u{u}", D(2024, 1, 1) + dt.timedelta(d)) for u in range(30) for d in range(90) if rng.random() < (0.2 + u / 40)]
    rows += [("None", D(2024, 1, 1)), ("never", None)]
    want = {}
    for a, d in rows:
        if d and a != "None":
            want.setdefault(a, set()).add(d)
    want = {a: python_streak(days) for a, days in want.items()}
    df = stg(spark, rows)
    week = F.date_trunc("week", "day").cast("date")
    steps = {
        "weeks": [], "months": [F.date_trunc("month", "period").cast("date")],
        "pairs": [F.date_sub("period", (F.datediff("period", F.lit(D(2024, 1, 1))) % 14).cast("int"))],
        "both": [F.date_sub("period", (F.datediff("period", F.lit(D(2024, 1, 1))) % 14).cast("int")), F.date_trunc("quarter", "period").cast("date")],
    }
    for name, periods in steps.items():
        runs = user_days.period_runs(df, week)
        for p in periods:
            runs = user_days.combined_runs(runs, p)
        got = {r.author_id: r.longest_streak for r in user_days.longest_streaks(user_days.combined_runs(runs)).collect()}
        assert got == want, name
    # by single days: nothing but merging
    days = user_days.combined_runs(user_days.period_runs(df, F.col("day")))
    assert {r.author_id: r.longest_streak for r in user_days.longest_streaks(days).collect()} == want


# ---------- bucketed join (J2), rejects


def test_bucketed_tables_join_without_exchange(spark, tmp_dir):
    name = os.path.basename(tmp_dir).replace("-", "_")
    comments = spark.createDataFrame([(f"p{i % 40}", f"c{i}", 1704672000.0 + i) for i in range(400)], "post_id string, comment_id string, created_utc double")
    for c in ("parent_id", "author_name", "distinguished", "edited"):
        comments = comments.withColumn(c, F.lit(None).cast("string"))
    comments = comments.withColumns({"score": F.lit(1).cast("long"), "is_submitter": F.lit(True), "replies": F.lit(None).cast("long")})
    posts = spark.createDataFrame([(f"p{i}", "s") for i in range(0, 60, 2)] * 2, "post_id string, subreddit string")
    communities = spark.createDataFrame([("s", 1.0)], "subreddit_name string, subscribers_count double")
    a = ingest.bucket_by_post(comments, f"comments_{name}", 4, os.path.join(tmp_dir, "c"))
    b = ingest.bucket_by_post(posts, f"posts_{name}", 4, os.path.join(tmp_dir, "p"))
    assert len([f for f in os.listdir(os.path.join(tmp_dir, "c")) if f.endswith(".parquet")]) == 4
    got = ingest.ingest_comments(a, b, communities, names=["s"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ingest.ingest_comments(a, b, communities, names=["s"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = ingest.ingest_comments(comments, posts, communities, names=["s"])
    assert sorted(r.comment_id for r in got.collect()) == sorted(r.comment_id for r in want.collect()) and got.count() == 200


def test_repeated_ingest_keeps_one_quarantine(spark, tmp_dir):
    from agora import jobs

    d = lambda *p: os.path.join(tmp_dir, *p)
    os.makedirs(d("listing", "snapshot_date=2024-01-08"))
    with open(d("listing", "snapshot_date=2024-01-08", "a.json"), "w") as fh:
        for r in (dict(subreddit="s", hot_rank=1, post_id="ok", created=1704672060.0, author_id="u"), dict(subreddit="s", hot_rank=2, post_id="gone", created=1704672060.0)):
            fh.write(json.dumps(r) + "\n")
        fh.write("{broken\n")
    with open(d("subs.csv"), "w") as fh:
        fh.write("subreddit_name,subscribers_count\ns,1\n")
    for _ in range(2):
        jobs.main(["ingest-posts", "--communities", d("subs.csv"), "--snapshots", d("listing"), "--out", d("posts"), "--run-date", "2024-01-08", "--quarantine", d("q")])
    assert [r.post_id for r in spark.read.json(d("q", "rejected")).collect()] == ["gone"]
    assert spark.read.text(d("q", "corrupt")).count() == 1


def test_report_cli_reads_published_runs_and_prunes(spark, tmp_dir):
    from agora import jobs

    d = lambda *p: os.path.join(tmp_dir, *p)
    staging.publish_staging(stg(spark, [("a", D(2024, 1, 8)), ("a", D(2024, 1, 9)), ("b", D(2023, 1, 10))]), d("stg"), "2023-01-01", "2024-02-01")
    jobs.main(["report", "active_days", "--staging", d("stg"), "--out", d("all_years")])
    assert {(r[0], r[1]) for r in spark.read.parquet(d("all_years")).collect()} == {("a", 2), ("b", 0)}
    jobs.main(["report", "active_days", "--staging", d("stg"), "--out", d("pruned"), "--prune"])
    assert {(r[0], r[1]) for r in spark.read.parquet(d("pruned", "active_days")).collect()} == {("a", 2)}
    assert sorted(os.listdir(d("pruned"))) == ["active_days", "masks"]

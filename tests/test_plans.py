"""Physical-plan properties the scale design relies on.

These read ``explain`` output, so they catch a change that keeps results right
but loses pushdown, a pre-shuffle limit or a partial aggregate.
"""

import re

import pytest

from agora.plans import catalog
from tests.conftest import SF_CHECK, SF_SMALL


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    names = [n for n in catalog.QUERIES if n != "content_flag_stream"]
    return {n: plan_text(catalog.QUERIES[n](spark, SF_CHECK)) for n in names}


def exchanges(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.mark.parametrize(
    "name", ["weekly_active_days", "weekly_activity_rate", "consecutive_day_flags", "weekly_active_days_sql"]
)
def test_week_mask_is_one_partial_aggregate(plans, name):
    text = plans[name]
    assert exchanges(text) == 1
    assert "partial_bit_or" in text
    assert "Generate" not in text and "collect_set" not in text


def test_literal_form_has_calendar_and_day_sets(plans):
    text = plans["weekly_active_days_literal"]
    assert "Generate explode" in text and "collect_set" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_daily_staging_window_is_pushed_to_scan(plans):
    text = plans["dim_all_users_stage"]
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-08", text)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(ts,2024-01-09", text)


@pytest.mark.parametrize("name,limit", [("top_posts_per_community", 100), ("posts_ingest", 100), ("sample_post_json", 10)])
def test_group_limit_runs_before_the_shuffle(plans, name, limit):
    text = plans[name]
    # Partial limit below the exchange, final limit above it.
    assert re.search(rf"WindowGroupLimit .*row_number\(\), {limit}, Final", text)
    assert re.search(rf"WindowGroupLimit .*row_number\(\), {limit}, Partial", text)


def test_top_communities_take_ordered_and_in_filter(plans):
    assert "TakeOrderedAndProject(limit=25" in plans["top_n_communities"]
    ingest = plans["posts_ingest"]
    # The 25 names restrict the listing as an IN filter, not as a join.
    assert re.search(r"Filter .* INSET Customer#", ingest)
    assert "LeftSemi" not in ingest


def test_top_communities_prune_landed_partitions(spark, tmp_dir):
    from agora.plans import ingest
    from agora.sources import standins

    # A landing zone partitioned by community (sf0.001: 150 community folders).
    snaps = standins.post_snapshots(spark, SF_SMALL)
    snaps.coalesce(1).write.partitionBy("subreddit").parquet(f"{tmp_dir}/snap")
    landed = spark.read.parquet(f"{tmp_dir}/snap")
    posts = ingest.ingest_posts(landed, standins.communities(spark, SF_SMALL), hot_order=standins.standin_hot_order())
    text = plan_text(posts)
    assert re.search(r"PartitionFilters: \[subreddit[^ ]* INSET Customer#", text)
    expect = catalog.QUERIES["posts_ingest"](spark, SF_SMALL)
    # Compare collected rows (exceptAll over two such plans is very slow to optimise).
    assert sorted(map(tuple, posts.select(*expect.columns).collect())) == sorted(map(tuple, expect.collect()))


def test_no_cross_joins_anywhere(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_scans_read_only_used_columns(plans):
    # The flag queries never read the document text; staging reads two columns of events.
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plans["content_flag_batch"]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plans["dim_all_users_backfill"]
    for name, text in plans.items():
        assert "text:string" not in text, name


def test_no_python_udfs(plans):
    for name, text in plans.items():
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name
        assert "FlatMapGroupsInPandas" not in text and "MapInPandas" not in text, name

"""Hot keys: a user or community holding half of all rows must not reach the
shuffle as half of all rows.  Reads shuffle metrics of the executed plan."""

import contextlib
import datetime as dt

from pyspark.sql import functions as F

from agora.operators.activity import week_masks
from agora.operators.counts import reply_counts
from agora.operators.topn import first_n_per_group

MONDAY = dt.date(2024, 1, 8)


def _children(node):
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def shuffle_records(df) -> int:
    """Run ``df`` and sum ``shuffleRecordsWritten`` over the exchanges the operator
    itself requires (the fixture's own ``repartition`` is not counted)."""
    df.collect()  # runs through df's own QueryExecution, whose plan we then read
    plan = df._jdf.queryExecution().executedPlan()
    total = 0
    stack = [plan]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):  # stages are leaves; their subtree is ``plan``
            stack.append(node.plan())
            continue
        if name == "ShuffleExchangeExec" and node.shuffleOrigin().toString() == "ENSURE_REQUIREMENTS":
            metrics = node.metrics()
            if metrics.contains("shuffleRecordsWritten"):
                total += metrics.apply("shuffleRecordsWritten").value()
        stack.extend(_children(node))
    return total


def test_hot_user_combined_before_shuffle(spark):
    hot = spark.range(0, 60_000).select(F.lit("hot").alias("author_id"), (F.col("id") % 7).alias("d"))
    cold = spark.range(0, 60_000).select(F.concat(F.lit("u"), (F.col("id") % 100).cast("string")).alias("author_id"),
                                         (F.col("id") % 7).alias("d"))
    staging = (
        hot.unionByName(cold)
        .select("author_id", F.date_add(F.lit(MONDAY), F.col("d").cast("int")).alias("etl_ts"))
        .repartition(8)
    )
    masks = week_masks(staging)
    records = shuffle_records(masks.select("author_id", "mask"))
    # One row per (map task, user) at most: 8 tasks x 101 users, not 120k rows.
    assert 0 < records <= 8 * 101
    got = {r.author_id: r.mask for r in masks.collect()}
    assert got["hot"] == 127 and len(got) == 101


def test_hot_community_capped_before_shuffle(spark):
    posts = spark.range(0, 80_000).select(
        F.when(F.col("id") < 40_000, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("subreddit"),
        F.col("id").alias("ups"),
    ).repartition(8)
    top = first_n_per_group(posts, ["subreddit"], [F.col("ups").desc()], 10)
    records = shuffle_records(top)
    # The partial group limit keeps <= 10 rows per (map task, community).
    assert 0 < records <= 8 * 51 * 10
    assert top.count() == 51 * 10


def test_hot_post_reply_counts_spread(spark):
    # One post holds half of all comments; the count/join keys include the comment id.
    tree = spark.range(0, 20_000).select(
        F.when(F.col("id") < 10_000, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 10).cast("string"))).alias("post_id"),
        F.col("id").cast("string").alias("comment_id"),
        F.when(F.col("id") % 2 == 1, (F.col("id") - 1).cast("string")).alias("parent_id"),
    )
    out = reply_counts(tree)
    assert out.count() == 20_000
    by_post = out.where(F.col("post_id") == "hot").agg(F.sum("replies")).first()[0]
    assert by_post == 5_000


SKEW_SPLIT_CONF = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def session_conf(spark, overrides):
    before = {k: spark.conf.get(k, None) for k in overrides}
    try:
        for k, v in overrides.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def final_plan_text(df) -> str:
    df.collect()  # runs df's own plan, read below
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    return plan.toString()


def test_hot_post_split_by_aqe_skew_join(spark):
    """Post keys above the broadcast bound: a shuffle join, and AQE splits the hot post."""
    from agora.plans import ingest
    from agora.schemas import COMMENT_SNAPSHOT

    with session_conf(spark, SKEW_SPLIT_CONF):
        n = 40_000
        comments = spark.range(0, n).select(
            F.when(F.col("id") < n // 2, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("post_id"),
            F.lit(None).cast("string").alias("parent_id"),
            F.col("id").cast("string").alias("comment_id"),
            F.lit("u").alias("author_name"),
            F.lit(1).cast("bigint").alias("score"),
            (F.lit(1704672000.0) + F.col("id")).alias("created_utc"),
            F.lit(None).cast("boolean").alias("is_submitter"),
            F.lit(None).cast("string").alias("distinguished"),
            F.lit(None).cast("string").alias("edited"),
            F.lit(None).cast("bigint").alias("replies"),
        ).select(*[f.name for f in COMMENT_SNAPSHOT.fields])
        stored = spark.range(0, 500).select(F.col("id").cast("string").alias("post_id"), F.lit("c").alias("subreddit"))
        stored = stored.unionByName(spark.createDataFrame([("hot", "c")], "post_id string, subreddit string"))
        comms = spark.createDataFrame([("c", 1.0)], "subreddit_name string, subscribers_count double")
        out = ingest.ingest_comments(comments, stored, comms)
        text = final_plan_text(out)
        assert "SortMergeJoin(skew=true)" in text, text[:3000]
        assert out.count() == n


def test_hot_community_split_in_content_flag(spark):
    """Flag lookups above the broadcast bound: left outer shuffle joins, the hot community split."""
    from agora.plans import moderation

    with session_conf(spark, SKEW_SPLIT_CONF):
        n = 40_000
        events = spark.range(0, n).select(
            F.when(F.col("id") < n // 2, F.lit("hot")).otherwise((F.col("id") % 200).cast("string")).alias("subreddit"),
            F.col("id").cast("string").alias("thread_id"),
            F.lit(None).cast("string").alias("author_id"),
            F.lit(None).cast("string").alias("creation_date"),
            F.lit(None).cast("string").alias("url"),
            F.lit(None).cast("boolean").alias("is_violation"),
        )
        post_flags = spark.range(0, n, 2).select(F.col("id").cast("string").alias("thread_id"), F.lit(True).alias("post_adult"))
        community_flags = spark.range(0, 200).select(
            F.col("id").cast("string").alias("subreddit"), (F.col("id") % 2 == 0).alias("community_adult")
        ).unionByName(spark.createDataFrame([("hot", False)], "subreddit string, community_adult boolean"))
        out = moderation.apply_content_flag(events, post_flags, community_flags)
        text = final_plan_text(out)
        assert "SortMergeJoin(skew=true)" in text, text[:3000]
        got = out.groupBy("is_violation").count().collect()
        assert sum(r["count"] for r in got) == n


def test_salted_join_spreads_hot_key(spark):
    """The stream-side salted join: a key with a third of the rows lands on many reducers."""
    from agora.operators.joins import salted_join

    # AQE skew handling off, as in a micro-batch: only the salt spreads the key.
    no_aqe_split = {**SKEW_SPLIT_CONF, "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.skewJoin.enabled": "false"}
    with session_conf(spark, no_aqe_split):
        n = 30_000
        big = spark.range(0, n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 100).cast("string")).alias("k"),
            F.col("id"),
        )
        lookup = spark.range(0, 100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
        lookup = lookup.unionByName(spark.createDataFrame([("hot", 2)], "k string, v int"))
        plain = big.join(lookup, "k", "left")
        salted = salted_join(big, lookup, ["k"], "left", 16)

        def hot_reducers(df):
            rows = df.where(F.col("k") == "hot").groupBy(F.spark_partition_id().alias("p")).count().collect()
            return len(rows), max(r["count"] for r in rows)

        assert hot_reducers(plain) == (1, n // 3)  # unsalted: the hot key is one reducer's whole input
        reducers, biggest = hot_reducers(salted)
        assert reducers >= 8 and biggest < n // 3 // 4
        assert salted.count() == plain.count() == n

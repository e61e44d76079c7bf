"""Distinct rows in pieces whose number grows with the input."""

from collections import Counter

from pyspark.sql import functions as F

from agora.operators.distinct import distinct_rows
from agora.plans import catalog


def test_distinct_rows_in_pieces(spark, tmp_dir):
    rows = [(None if i % 7 == 0 else f"c{i % 50}", None if i % 11 == 0 else str(i % 900)) for i in range(4000)]
    spark.createDataFrame(rows, "subreddit string, post_id string").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    got = distinct_rows(df, piece_bytes=4000)
    assert Counter(map(tuple, got.collect())) == Counter(set(rows))
    assert got.rdd.getNumPartitions() > 2
    rdd = spark.createDataFrame([("a", "1"), ("a", "1")], "subreddit string, post_id string")
    assert [tuple(r) for r in distinct_rows(rdd).collect()] == [("a", "1")]


def test_post_ids_of_many_orders_make_no_large_task(spark, tmp_dir):
    n = 2_500_000
    orders = spark.range(n).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 5000).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.rand(3).alias("o_totalprice"), F.lit("2024-01-02").cast("timestamp_ntz").alias("o_orderdate"),
    )
    orders.write.parquet(f"{tmp_dir}/orders.parquet")
    r = catalog.QUERIES["distinct_post_ids"](spark, tmp_dir)
    sizes = r.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[1] == n and sizes[0] < 1_500_000

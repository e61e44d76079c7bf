"""Adult-content flag (Q7, batch form) and the sample-post JSON (Q8).

Q7 marks an adult post in a community that is not adult.  The reference
looks both flags up remotely per event inside a scalar function; here they are
two left joins against lookup tables (post flags by thread id, community flags
by name), followed by the three-valued rule.  ``apply_content_flag`` is shared
by the batch query and the streaming job, so the two cannot drift apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.functions.cleaning import FLAG_RULE_SQL, epoch_text, flag_adult_in_safe_community
from agora.functions.json import encode_json
from agora.operators.joins import lookup_join
from agora.operators.topn import last_of_first_n
from agora.schemas import POST_EVENT_FIELDS

# Name of the SQL function with the flag rule.
FLAG_FUNCTION = "is_adult_post_in_safe_community"
# Posts per community the sample looks at (fixed value of the generator).
SAMPLE_LISTING = 10
SAMPLE_FIELDS = ("subreddit", "thread_id", "author_id", "creation_date", "url")


def apply_content_flag(
    events: DataFrame,
    post_flags: DataFrame,
    community_flags: DataFrame,
    salt_buckets: int = 1,
) -> DataFrame:
    """Post events with ``is_violation`` recomputed (an incoming value is ignored).

    ``post_flags``: ``thread_id, post_adult``; ``community_flags``:
    ``subreddit, community_adult``; both one row per key.  Works on a batch or a
    streaming ``events`` frame (stream-static left joins).
    """
    base = events.drop("is_violation")
    with_post = lookup_join(base, post_flags, "thread_id", "left", salt_buckets)
    with_both = lookup_join(with_post, community_flags, "subreddit", "left", salt_buckets)
    flag = flag_adult_in_safe_community("post_adult", "community_adult")
    return with_both.select(*[c for c in POST_EVENT_FIELDS if c != "is_violation"], flag.alias("is_violation"))


def post_flags_from_posts(posts: DataFrame) -> DataFrame:
    """Post flags from the stored posts: ``thread_id, post_adult``.

    The store keeps ``over_18`` only when true, so a stored post without it is
    not adult; a post that is not stored at all stays unknown (no row).  Posts
    appended twice collapse to one row (adult if any copy says so).
    """
    return (
        posts.where(F.col("post_id").isNotNull())
        .groupBy(F.col("post_id").alias("thread_id"))
        .agg(F.bool_or(F.coalesce(F.col("over_18"), F.lit(False))).alias("post_adult"))
    )


def register_flag_function(spark: SparkSession, name: str = FLAG_FUNCTION) -> str:
    """Register the flag rule as a SQL function (inlined by the analyzer, no Python worker).

    ``SELECT ..., is_adult_post_in_safe_community(post_adult, community_adult)``
    then gives the same result as ``apply_content_flag``.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(post_adult BOOLEAN, community_adult BOOLEAN) "
        f"RETURNS BOOLEAN RETURN {FLAG_RULE_SQL}"
    )
    return name


def sample_post_json(
    posts: DataFrame,
    hot_order: Sequence[Column],
    listing: int = SAMPLE_LISTING,
) -> DataFrame:
    """Per community, the last of its first ``listing`` hot posts, as a JSON event.

    ``posts`` carries ``subreddit, post_id, author_id, created, url``.  Output:
    ``subreddit, sample_json`` with the event fields ``subreddit, thread_id,
    author_id, creation_date, url`` (creation time as Python prints a float).
    """
    picked = last_of_first_n(
        posts,
        ["subreddit"],
        hot_order,
        listing,
        ["subreddit", "post_id", "author_id", "created", "url"],
    )
    event = picked.select(
        "subreddit",
        F.col("post_id").alias("thread_id"),
        "author_id",
        epoch_text("created").alias("creation_date"),
        "url",
    )
    return event.select("subreddit", encode_json(SAMPLE_FIELDS).alias("sample_json"))

"""Comment trees of any depth: nested JSON -> the flat rows that the comment ingest takes.

A landed post carries its comments as JSON text, replies inside replies.  No schema can
say how deep that goes, so the text becomes one VARIANT and a recursive query walks it: a
step takes the replies of all comments of the level before, for all posts at once, and it
ends with the level that has none.  Steps are narrow (parse, explode): nothing is
shuffled, and a level holds only what hangs below it.

A comment is an object with a ``comment_id``.  Other objects (the placeholders of
collapsed comments) give no row; what hangs below them goes to the nearest comment above.
``replies`` is the number of direct replies, placeholders not counted, and none is
missing, as the store has it.  Fields of a wrong type are missing; a text that is no JSON
array gives its post to the rejects.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.schemas import COMMENT_SNAPSHOT

# How deep a tree may be before the query fails (a site's own limit is far below).
MAX_DEPTH = 10_000

# How each stored field is read from a comment (the rest of COMMENT_SNAPSHOT is made here).
_OWN = ("post_id", "parent_id", "comment_id", "replies")


def split_trees(posts: DataFrame, comments: str = "comments") -> tuple[DataFrame, DataFrame]:
    """(posts whose ``comments`` is a JSON array or missing, the others)."""
    kind = F.schema_of_variant(F.try_parse_json(comments))
    is_tree = F.col(comments).isNull() | F.coalesce(kind.startswith("ARRAY"), F.lit(False))
    return posts.where(is_tree), posts.where(~is_tree)


def walk(posts: DataFrame, comments: str = "comments", max_depth: int = MAX_DEPTH) -> DataFrame:
    """``post_id, parent_id, depth, node``: every object of the trees, as a VARIANT.

    A placeholder hands its own parent on, and its depth.
    """
    spark = posts.sparkSession
    view = f"agora_trees_{uuid.uuid4().hex[:12]}"
    posts.select("post_id", F.try_parse_json(comments).alias("tree")).createOrReplaceTempView(view)
    # LIMIT ALL lifts the row limit of a recursion, which is a guard for interactive queries
    return spark.sql(
        f"""
        WITH RECURSIVE walk(post_id, parent_id, depth, node) MAX RECURSION LEVEL {int(max_depth)} AS (
            SELECT post_id, CAST(NULL AS STRING), 0, top.value
            FROM {view}, LATERAL variant_explode(tree) AS top
            UNION ALL
            SELECT post_id,
                   coalesce(try_variant_get(node, '$.comment_id', 'string'), parent_id),
                   depth + IF(try_variant_get(node, '$.comment_id', 'string') IS NULL, 0, 1),
                   reply.value
            FROM walk, LATERAL variant_explode(try_variant_get(node, '$.replies', 'variant')) AS reply
        )
        SELECT * FROM walk LIMIT ALL
        """
    )


def flat_comments(posts: DataFrame, comments: str = "comments", max_depth: int = MAX_DEPTH) -> DataFrame:
    """COMMENT_SNAPSHOT rows (and ``depth``) of every comment of the trees.

    The replies are counted on (post, parent) with a partial aggregate before its
    exchange, and joined to the comments on (post, comment): a post that holds a third of
    all comments spreads over them.
    """
    nodes = walk(posts, comments, max_depth)
    field = lambda name, kind: F.expr(f"try_variant_get(node, '$.{name}', '{kind}')")
    rows = nodes.select(
        "post_id", "parent_id", "depth", field("comment_id", "string").alias("comment_id"),
        *[field(f.name, f.dataType.simpleString()).alias(f.name) for f in COMMENT_SNAPSHOT.fields if f.name not in _OWN],
    ).where(F.col("comment_id").isNotNull())
    n = (
        rows.where(F.col("parent_id").isNotNull())
        .groupBy("post_id", F.col("parent_id").alias("comment_id"))
        .agg(F.count("*").alias("replies"))
    )
    return rows.join(n, ["post_id", "comment_id"], "left").select(*COMMENT_SNAPSHOT.names, "depth")

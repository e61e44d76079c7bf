"""Readers for the driver's Parquet tables.

Each reader selects only the columns the jobs use, so the scan's ReadSchema
is pruned even before Catalyst's own column pruning runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


# Column types of the driver tables the jobs read (fixed values, as stored in
# the Parquet files).  Passing them to the reader skips schema inference (a
# footer read per table and call) and makes a type drift fail loudly.
COLUMN_TYPES = {
    "customer": {
        "c_custkey": "BIGINT", "c_name": "STRING", "c_nationkey": "INT",
        "c_acctbal": "DOUBLE", "c_mktsegment": "STRING",
    },
    "orders": {
        "o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "STRING",
        "o_totalprice": "DOUBLE", "o_orderdate": "TIMESTAMP_NTZ", "o_orderpriority": "STRING",
    },
    "events": {
        "event_id": "BIGINT", "ts": "TIMESTAMP_NTZ", "user_id": "BIGINT",
        "event_type": "STRING", "value": "DOUBLE", "props": "STRING",
    },
    "documents": {
        "doc_id": "BIGINT", "text": "STRING", "lang": "STRING", "source": "STRING", "n_chars": "BIGINT",
    },
    "labels": {"doc_id": "BIGINT", "quality": "INT", "toxic": "INT"},
    "conversations": {"conv_id": "BIGINT", "turn": "BIGINT", "role": "STRING", "text": "STRING"},
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read a driver table; with ``columns`` only those are read (by declared type when known)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    types = COLUMN_TYPES.get(name, {})
    if columns and all(c in types for c in columns):
        ddl = ", ".join(f"`{c}` {types[c]}" for c in columns)
        return spark.read.schema(ddl).parquet(table_path(sf_dir, name))
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df

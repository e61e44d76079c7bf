"""Order-insensitive comparison of a Spark result with a DuckDB query."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

from agora.sources.tables import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = rel.fetchall()
    return [names[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(con, sql)
    assert s_cols == d_cols, f"columns differ: spark={s_cols} duckdb={d_cols}"
    n_s, n_d = sum(s_rows.values()), sum(d_rows.values())
    assert n_s == n_d, f"row counts differ: spark={n_s} duckdb={n_d}"
    only_s = s_rows - d_rows
    only_d = d_rows - s_rows
    assert not only_s and not only_d, (
        f"values differ; spark-only {list(only_s.items())[:5]} duckdb-only {list(only_d.items())[:5]}"
    )
    return n_s

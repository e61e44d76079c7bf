"""Run every registered query against its DuckDB oracle, like the driver's gate.

    python tools/check_oracle.py [sf_dir] [query ...]

Uses a plain ``local[*]`` session (no agora session helper), calls
``entry()`` once, then compares each query's rows with its oracle SQL:
column names, row count and an order-insensitive multiset of values (floats
rounded to 9 decimals).  Exits non-zero when any query differs.
"""

from __future__ import annotations

import importlib.util
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    from pyspark.sql import SparkSession

    from tests.oracle import compare, duck

    spark = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    smoke = entry.entry(spark)
    print(f"entry: {smoke.count()} rows, {smoke.schema.simpleString()}")

    con = duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sorted(queries):
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        if name not in oracle:
            print(f"ROWS {name:30s} rows={queries[name](spark, sf_dir).count():7d} (no oracle)")
            continue
        try:
            n = compare(queries[name](spark, sf_dir), con, oracle[name])
            print(f"OK   {name:30s} rows={n:7d} {time.perf_counter() - t0:6.2f}s")
        except AssertionError as exc:
            failed += 1
            print(f"FAIL {name:30s} {str(exc)[:400]}")
    print(f"{len(queries) - failed} of {len(queries)} match at {sf_dir}")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

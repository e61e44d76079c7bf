"""Bench: time every registered query at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 5).  Each query is run once to warm up, then
BENCH_REPEAT times; its time is the best run.  A run builds the query and executes the whole plan into Spark's no-op sink (no
collect to the driver).  Queries that replay several loads or stream batches
(``catalog.SCENARIOS``) run only when BENCH_QUERIES names them.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from agora.plans import catalog
    from agora.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="agora-bench", shuffle_partitions=max(cpus, 4))
    names = only or sorted(set(catalog.QUERIES) - catalog.SCENARIOS)
    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        fn = catalog.QUERIES.get(name)
        if fn is None:
            failed[name] = "no such query"
            continue

        def run() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - t0
            return elapsed

        try:
            run()  # warm-up: JIT, file listing, Python imports
            timings[name] = round(min(run() for _ in range(repeat)), 4)
        except Exception as exc:  # one failing query must not lose the whole line
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            print(f"bench: {name} failed: {failed[name]}", file=sys.stderr)

    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "sum_best_query_seconds",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                **({"failed": failed} if failed else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

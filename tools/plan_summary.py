"""Summarise the executed plan of every registered query (for PLANS.md).

    python tools/plan_summary.py [sf_dir]

Runs each query once (so AQE's final plan is known) and prints one markdown
row per query: exchanges, joins, group limits, aggregates, pushed filters and
the columns read per scan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_plan(df) -> str:
    """The executed plan after AQE (the adaptive node's final plan, stages expanded)."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    return plan.toString()


def summarise(text: str) -> dict[str, str]:
    exchanges = re.findall(r"Exchange (hashpartitioning\(([^)]*)\)|SinglePartition|rangepartitioning)", text)
    keys = sorted({re.sub(r"#\d+L?", "", e[1]).rsplit(",", 1)[0] for e in exchanges if e[1]})
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)[^\n]*?(Inner|LeftOuter|LeftSemi|LeftAnti)", text)))
    limits = sorted(set(re.findall(r"WindowGroupLimit .*?row_number\(\), (\d+), (Partial|Final)", text)))
    pushed = sorted(set(p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", text) if p))
    reads = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", text)))
    # Operators Spark runs outside whole-stage codegen (code-generated ones print as ``*(n) Op``);
    # exchanges, stage wrappers and scans are boundaries by design and left out.
    boundaries = {"Exchange", "BroadcastExchange", "ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage",
                  "ReusedExchange", "AQEShuffleRead", "FileScan", "Scan", "InMemoryTableScan", "InMemoryRelation",
                  "AdaptiveSparkPlan", "ColumnarToRow", "TableCacheQueryStage"}
    # The plan of a persisted lookup is printed under InMemoryRelation without
    # codegen markers; its subtree is skipped.
    outside = set()
    skip_below = None
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-|"))
        if skip_below is not None and depth > skip_below:
            continue
        skip_below = None
        if "InMemoryRelation" in line:
            skip_below = depth
            continue
        m = re.match(r"^[\s:+\-]*(\*\(\d+\) )?([A-Z][A-Za-z]+)", line)
        if m and not m.group(1) and m.group(2) not in boundaries:
            outside.add(m.group(2))
    return {
        "no codegen": ", ".join(sorted(outside)) or "—",
        "exchanges": f"{len(exchanges)}" + (f" on {'; '.join(keys)}" if keys else ""),
        "joins": ", ".join(f"{j} {t}" for j, t in joins) or "—",
        "group limits": ", ".join(f"{n} {k}" for n, k in limits) or "—",
        "partial agg": "yes" if "partial_" in text else "—",
        "pushed": "; ".join(pushed) or "—",
        "reads": "; ".join(reads),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from agora.plans import catalog
    from agora.session import build_session

    spark = build_session("local[4]", shuffle_partitions=8)
    print("| query | exchanges (keys) | joins | group limits | partial agg | outside codegen | pushed filters | columns read |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in sorted(catalog.QUERIES):
        if name == "content_flag_stream":
            continue
        df = catalog.QUERIES[name](spark, sf_dir)
        df.collect()
        text = final_plan(df)
        s = summarise(text)
        print(f"| `{name}` | {s['exchanges']} | {s['joins']} | {s['group limits']} | {s['partial agg']} | "
              f"{s['no codegen']} | {s['pushed']} | {s['reads']} |")
    spark.stop()


if __name__ == "__main__":
    main()

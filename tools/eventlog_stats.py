"""Run the registered queries once with Spark's event log on and summarise it.

    python tools/eventlog_stats.py [sf_dir] [cpus]

The event log goes to a fresh scratch folder (no UI, no server).  Prints
stages, tasks, median / p95 / longest task time and bytes spilled, i.e. the
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(log_dir: str) -> dict:
    import zstandard

    stage_job: dict[int, str] = {}
    durations: list[int] = []
    longest = (0, "")
    spilled = 0
    stages = 0
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True):
        raw = open(path, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if path.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8", errors="ignore"):
            try:
                event = json.loads(line)
            except ValueError:
                continue
            kind = event.get("Event")
            if kind == "SparkListenerJobStart":
                for stage in event["Stage IDs"]:
                    stage_job[stage] = event.get("Properties", {}).get("spark.job.description", "")
            elif kind == "SparkListenerTaskEnd":
                info, metrics = event["Task Info"], event.get("Task Metrics") or {}
                took = info["Finish Time"] - info["Launch Time"]
                durations.append(took)
                if took > longest[0]:
                    longest = (took, stage_job.get(event["Stage ID"], ""))
                spilled += metrics.get("Memory Bytes Spilled", 0) + metrics.get("Disk Bytes Spilled", 0)
            elif kind == "SparkListenerStageCompleted":
                stages += 1
    durations.sort()
    pick = lambda q: durations[min(len(durations) - 1, int(len(durations) * q))] if durations else 0
    return {
        "stages": stages,
        "tasks": len(durations),
        "median_task_ms": pick(0.5),
        "p95_task_ms": pick(0.95),
        "longest_task_ms": longest[0],
        "longest_in": longest[1],
        "bytes_spilled": spilled,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    from agora.plans import catalog
    from agora.session import build_session

    log_dir = tempfile.mkdtemp(prefix="agora-eventlog-")
    spark = build_session(
        f"local[{cpus}]",
        app_name="agora-eventlog",
        extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir},
    )
    for name in sorted(catalog.QUERIES):
        spark.sparkContext.setJobDescription(name)
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    print(json.dumps({"sf_dir": sf_dir, "queries": len(catalog.QUERIES), **summarise(log_dir)}))


if __name__ == "__main__":
    main()

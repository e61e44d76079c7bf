"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = {
        **os.environ,
        "BENCH_SF_DIR": SF_SMALL,
        "BENCH_CPUS": "2",
        "BENCH_REPEAT": "1",
        "BENCH_QUERIES": "top_n_communities,weekly_active_days",
    }
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True, timeout=600
    )
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["metric"] and result["sf"] == 0.001
    assert set(result["queries"]) == {"top_n_communities", "weekly_active_days"}
    assert result["value"] == round(sum(result["queries"].values()), 4)
    assert "failed" not in result

"""Results must not depend on the driver machine's time zone."""

import os
import subprocess
import sys
import textwrap

from tests.conftest import ROOT, SF_CHECK

CODE = textwrap.dedent(
    f"""
    import sys, tempfile
    sys.path.insert(0, {ROOT!r})
    from agora.session import build_session
    from agora.plans import catalog
    spark = build_session("local[2]", shuffle_partitions=2,
                          extra_conf={{"spark.sql.warehouse.dir": tempfile.mkdtemp()}})
    stage = catalog.QUERIES["dim_all_users_stage"](spark, {SF_CHECK!r}).count()
    day = catalog.QUERIES["comments_for_day"](spark, {SF_CHECK!r}).count()
    q1 = sorted(tuple(r) for r in catalog.QUERIES["weekly_active_days"](spark, {SF_CHECK!r}).collect())
    import hashlib
    print("RESULT", stage, day, hashlib.sha256(repr(q1).encode()).hexdigest())
    """
)


def run_in_zone(zone: str) -> str:
    env = {**os.environ, "TZ": zone}
    out = subprocess.run([sys.executable, "-c", CODE], env=env, capture_output=True, text=True, timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    return line[0]


def test_same_results_in_another_zone():
    pacific = run_in_zone("America/Los_Angeles")
    assert pacific.split()[1:3] == ["312", "10"]
    assert pacific == run_in_zone("UTC")

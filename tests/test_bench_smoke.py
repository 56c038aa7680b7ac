"""bench.py keeps its contract: one JSON line with metric, value, unit, queries, sf."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4", BENCH_REPS="1",
               CONCORD_DRIVER_MEMORY="4g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, lines
    doc = json.loads(lines[0])
    assert doc["metric"] == "headline_total" and doc["unit"] == "sec" and doc["sf"] == "0.001"
    assert doc["value"] > 0 and len(doc["queries"]) >= 20
    assert abs(sum(doc["queries"].values()) - doc["value"]) < 0.01 * len(doc["queries"])

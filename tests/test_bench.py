"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line(sf_small):
    env = dict(os.environ, BENCH_SF_DIR=sf_small, BENCH_CPUS="4")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], capture_output=True, text=True,
                         env=env, cwd=str(ROOT), timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["value"] > 0
    assert set(rec) >= {"metric", "value", "unit", "queries", "sf"}
    assert all(v > 0 for v in rec["queries"].values())

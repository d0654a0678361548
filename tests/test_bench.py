"""bench.py prints one JSON line with the fields the driver records."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line(sf_small):
    env = dict(os.environ, BENCH_SF_DIR=sf_small, BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_ONLY="stg_loans,mart_customer_360")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, cwd="/tmp",
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"stg_loans", "mart_customer_360"}
    assert result["value"] > 0 and result["build_all_sec"] > 0

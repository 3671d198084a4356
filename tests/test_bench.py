"""The bench runs and prints one JSON line."""

import json
import os
import subprocess
import sys
from pathlib import Path


def test_bench_runs_on_the_smallest_tables():
    root = Path(__file__).resolve().parents[1]
    env = os.environ | {"BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "4", "BENCH_MEMORY": "4g", "BENCH_QUICK": "1"}
    done = subprocess.run([sys.executable, "bench.py"], cwd=root, env=env, capture_output=True, text=True, timeout=1500)
    assert done.returncode == 0, done.stderr[-2000:]
    row = json.loads(done.stdout.strip().splitlines()[-1])
    assert row["unit"] == "sec" and row["queries"]["bpe_encode"] > 0 and row["value"] > 0

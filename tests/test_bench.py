"""bench.py prints exactly one JSON line, from any working directory."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not available")
def test_bench_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_REPS="1", BENCH_NAIVE_REPS="1",
               BENCH_DRIVER_MEMORY="2g")
    env.pop("PYTHONPATH", None)
    run = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         timeout=900, env=env, cwd=tempfile.mkdtemp(prefix="bench-cwd-"))
    assert run.returncode == 0, run.stderr[-2000:]
    lines = run.stdout.strip().splitlines()
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["value"] > 0 and out["sf"] == "0.001"
    assert {"monthly_metrics", "pipeline_end_to_end", "naive_pipeline"} <= set(out["queries"])

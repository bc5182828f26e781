"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys
from pathlib import Path

from tests.conftest import SF_SMALL


def test_bench_prints_one_json_line():
    repo = Path(__file__).resolve().parents[1]
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_REPEAT="1", BENCH_QUERIES="normalize,chunk_coverage",
               BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    proc = subprocess.run([sys.executable, str(repo / "bench.py")], capture_output=True, text=True,
                          timeout=600, env=env, cwd=str(repo))
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"normalize", "chunk_coverage"}
    assert abs(result["value"] - sum(result["queries"].values())) < 0.01

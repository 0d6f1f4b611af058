"""bench.py's contract with the driver: exactly one JSON line on stdout."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_QUERIES="fn_month_label,pred_month_range",
               BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    data = json.loads(lines[0])
    assert data["unit"] == "sec" and data["sf"] == 0.001 and data["metric"]
    assert set(data["queries"]) == {"fn_month_label", "pred_month_range"}
    assert abs(data["value"] - sum(data["queries"].values())) < 0.01

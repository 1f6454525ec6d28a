"""bench.py prints one JSON line in the expected shape."""
import json
import os
import subprocess
import sys

from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="fct_orders,usage_by_user")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    d = json.loads(lines[-1])
    assert d["unit"] == "sec" and d["sf"] == "0.001" and "failed" not in d
    assert set(d["queries"]) == {"fct_orders", "usage_by_user"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01

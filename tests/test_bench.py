import json
import os
import subprocess
import sys


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    names = ["path_conversion", "sample_cars", "write_result"]
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_WARMUP="0", BENCH_REPEAT="1", BENCH_QUERIES=",".join(names))
    proc = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                          capture_output=True, text=True, timeout=900)
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == "0.001" and "errors" not in out
    assert set(out["queries"]) == set(names)
    assert abs(out["value"] - sum(out["queries"].values())) < 0.01

"""Print a table of the static physical plan of every registered query.

Usage: python tests/plan_report.py [sf_dir]   (AQE off, so the plan is the
one Catalyst chose before runtime statistics.)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Queries whose plan reads back what they have written.
WRITES = ("stream_monitor_speed", "load_tsv", "write_result", "find_cars", "sketch_cars")


def summarize(plan: str) -> dict[str, int]:
    return {
        "scans": len(re.findall(r"FileScan parquet", plan)),
        "shuffles": len(re.findall(r"\bExchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "reused": plan.count("ReusedExchange"),
        "broadcasts": plan.count("BroadcastExchange"),
        "windows": len(re.findall(r"(?m)^\W*Window \[", plan)),
        "group_limits": plan.count("WindowGroupLimit"),
        "semi_joins": plan.count("LeftSemi"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from roadlens.plans.catalog import QUERIES
    from roadlens.session import build_session
    spark = build_session("local[8]", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    cols = ["scans", "shuffles", "reused", "broadcasts", "windows", "group_limits", "semi_joins"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for name, fn in QUERIES.items():
        if name in WRITES or name.startswith(("task_", "live_", "catalog_")):
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()

"""Summarise the executed (final adaptive) plan of every registered query into PLANS.md.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermart.plans import catalog  # noqa: E402
from ordermart.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    scans = re.findall(r"(?:FileScan|Scan) (parquet|json|csv|text)[^\n]*", plan)
    return {
        "shuffles": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|"
                                   r"\bExchange SinglePartition|\bExchange RoundRobin", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "scans": len(scans),
        "formats": sorted(set(scans)),
        "pushed": "PushedFilters: [" in plan and not re.search(r"PushedFilters: \[\]", plan),
        "partial_agg": plan.count("HashAggregate") + plan.count("ObjectHashAggregate"),
        "sort_agg": plan.count("SortAggregate"),
        "python": ("EvalPython" in plan) or ("PythonUDF" in plan),
        "top_k": "TakeOrderedAndProject" in plan,
        "window_limit": "WindowGroupLimit" in plan,
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Executed plans per query\n")
    print(f"Final adaptive plans after running each query on `{sf_dir}` (noop sink). "
          "shuffles = Exchange nodes (hash/range/single); partial = hash aggregate nodes; "
          "pushed = a scan carries PushedFilters; bhj/smj = broadcast / sort-merge joins.\n")
    print("| query | shuffles | broadcasts | bhj | smj | scans | partial | sort agg | top-k | "
          "window limit | pushed | python |")
    print("|---|---|---|---|---|---|---|---|---|---|---|---|")
    for key, fn in catalog.queries().items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {key} | {s['shuffles']} | {s['broadcasts']} | {s['bhj']} | {s['smj']} | "
              f"{s['scans']} {','.join(s['formats'])} | {s['partial_agg']} | {s['sort_agg']} | "
              f"{'y' if s['top_k'] else ''} | {'y' if s['window_limit'] else ''} | "
              f"{'y' if s['pushed'] else ''} | {'y' if s['python'] else 'no'} |")


if __name__ == "__main__":
    main()

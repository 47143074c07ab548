"""Summarize the final (adaptive) physical plan of each headline query.

Usage: python scripts/plan_shapes.py [sf_dir] [--full name]. Runs each query once, then counts in
its final plan: shuffles, broadcasts, sort-merge / broadcast-hash joins, top-k operators, and lists
the filters pushed into parquet scans. ``--full name`` prints that query's whole final plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from mutualis.plans import QUERIES  # noqa: E402
from mutualis.session import local_session  # noqa: E402


def shape(plan: str) -> dict:
    plan = plan.split("== Initial Plan ==")[0]  # the final adaptive plan only
    pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p})
    return {
        "shuffles": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|"
                                   r"\bExchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "topk": plan.count("TakeOrderedAndProject"),
        "cartesian/nl": plan.count("CartesianProduct") + plan.count("BroadcastNestedLoopJoin"),
        "python": plan.count("EvalPython"),
        "pushed": pushed,
    }


def main():
    args = sys.argv[1:]
    full = None
    if "--full" in args:
        i = args.index("--full")
        full = args[i + 1]
        args = args[:i] + args[i + 2:]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    spark = local_session(8, 16, app="mutualis-plans")
    print("| query | shuffles | broadcasts | SMJ | BHJ | top-k | cartesian/NL | python | filters pushed to parquet |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        pushed = "; ".join(s["pushed"]) or "-"
        print(f"| `{name}` | {s['shuffles']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | {s['topk']} | "
              f"{s['cartesian/nl']} | {s['python']} | {pushed} |")
        if name == full:
            print(plan)
    spark.stop()


if __name__ == "__main__":
    main()

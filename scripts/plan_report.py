"""Summarize the physical plan of every registered query (PLANS.md).

    python scripts/plan_report.py [--sf-dir DIR] > PLANS.md

Counts shuffles (Exchange), broadcasts, join strategies, windows and Python
stages in each query's executed plan (AQE initial plan, before runtime
re-planning), so a plan regression is visible in review.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from searchlake.session import build_session  # noqa: E402

# queries that write during construction (round trips) are summarized
# from their read-back plan only
PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition|Exchange \[",
    "broadcasts": r"BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "shj": r"ShuffledHashJoin",
    "nested_loop": r"BroadcastNestedLoopJoin|CartesianProduct",
    "windows": r"\bWindow \[|\bWindow\b(?!GroupLimit)",
    "group_limit": r"WindowGroupLimit",
    "python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas",
}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.001")
    a = ap.parse_args()
    from searchlake.plans import registry
    registry.load_all()
    spark = build_session(shuffle_partitions=8)
    print("# Plan report\n")
    print(f"Executed-plan shapes of the registered queries (`scripts/plan_report.py`, {a.sf_dir}). "
          "Counts are operator occurrences in the initial adaptive plan; AQE may still coalesce "
          "partitions, split skewed ones or turn a sort-merge join into a broadcast at run time.\n")
    print("| query | shuffles | broadcasts | BHJ | SMJ | nested loop | windows | group limit | python |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in sorted(registry.QUERIES.items()):
        try:
            plan = fn(spark, a.sf_dir)._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {type(e).__name__} | | | | | | | |")
            continue
        c = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
        print(f"| {name} | {c['shuffles']} | {c['broadcasts']} | {c['bhj']} | {c['smj'] + c['shj']} | "
              f"{c['nested_loop']} | {c['windows']} | {c['group_limit']} | {c['python']} |")
    spark.stop()


if __name__ == "__main__":
    main()

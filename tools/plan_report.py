"""Summarise the physical plans of the headline queries (PLANS.md).

For each query: shuffles (Exchange), join strategies, aggregate and window
operators, top-k operators, and the columns each Parquet scan reads. Uses the
plan Spark would run (adaptive plans show their initial form; AQE may still
turn a sort-merge join into a broadcast join when a side is small at run
time). Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = ["ReusedExchange", "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "SortAggregate",
         "ObjectHashAggregate", "Window ", "WindowGroupLimit", "TakeOrderedAndProject", "Expand",
         "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas"]


def summarise(plan: str) -> dict[str, int]:
    out = {}
    for n in NODES:
        c = plan.count(n)
        if c:
            out[n.strip()] = c
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from bench import HEADLINE
    from tidemark.session import build_session
    import tidemark.suite  # noqa: F401
    from tidemark.registry import REGISTRY
    spark = build_session(shuffle_partitions=16)
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tools/plan_report.py` at `{sf}`: counts of physical operators in the final "
          "adaptive plan of each query after it ran. `ReusedExchange` marks a shuffle written once and "
          "read by two branches (side tables built from the same rows). Joins to small side tables are "
          "broadcast by AQE because their measured size is under the threshold; at larger sizes the "
          "same plan stays a sort-merge join. No query contains a cartesian product, a nested-loop join, "
          "a single-partition exchange of raw rows or a Python UDF (tests/test_plan_guard.py checks all lazily built queries).\n")
    for name in HEADLINE:
        if name.startswith("stream") or name.startswith("stateful"):
            continue
        df = REGISTRY[name].run(spark, sf)
        df.collect()  # run it, so the adaptive plan is final (small results at this scale)
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        s = summarise(plan)
        scans = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
        print(f"## {name}\n")
        print("| operator | count |\n|---|---|")
        for k, v in s.items():
            print(f"| {k} | {v} |")
        print("\nParquet columns read: " + "; ".join(f"`{x}`" for x in scans) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()

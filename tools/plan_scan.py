"""Summarise the physical plan of every registered query: number of hash /
range exchanges and red flags (single-partition exchanges, nested-loop or
cartesian joins, Python evaluation).

usage: python tools/plan_scan.py [sf_dir] [--formatted name]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FLAGS = ("SinglePartition", "BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
         "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "BroadcastExchange")


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    from flowstat.plans import catalog
    from flowstat.session import get_session
    spark = get_session("local[8]", 16)
    if "--formatted" in args:
        catalog.QUERIES[args[args.index("--formatted") + 1]](spark, sf_dir).explain("formatted")
        return
    for name, fn in sorted(catalog.QUERIES.items()):
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        n_ex = plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")
        print(f"{name:36s} exchanges={n_ex:2d} {' '.join(f for f in FLAGS if f in plan)}")


if __name__ == "__main__":
    main()

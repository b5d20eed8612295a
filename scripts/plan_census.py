"""Count plan operators of every warehouse query's result (shuffles, joins, aggregates, windows).

usage: python scripts/plan_census.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = [("shuffle", r"Exchange hashpartitioning"), ("range", r"Exchange rangepartitioning"),
         ("single", r"Exchange SinglePartition"), ("bcast", r"BroadcastExchange"),
         ("BHJ", r"BroadcastHashJoin"), ("SMJ", r"SortMergeJoin"), ("BNLJ", r"BroadcastNestedLoopJoin"),
         ("cartesian", r"CartesianProduct"), ("hashAgg", r"\bHashAggregate"), ("objAgg", r"ObjectHashAggregate"),
         ("sortAgg", r"SortAggregate"), ("window", r"\bWindow\b"), ("pandas", r"FlatMapGroupsInPandas"),
         ("scans", r"FileScan parquet")]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from stratus.plans.catalog import QUERIES
    from stratus.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    print("| query | " + " | ".join(n for n, _ in NODES) + " |")
    print("|---|" + "---|" * len(NODES))
    for name, fn in QUERIES.items():
        p = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(rx, p)) for _, rx in NODES]
        print(f"| {name} | " + " | ".join(str(c) if c else "" for c in counts) + " |")


if __name__ == "__main__":
    main()

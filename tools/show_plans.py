"""Print the skeleton of each headline query's physical plan: scans (with
pushed filters and read schema), exchanges, joins, aggregates, windows.

usage: python tools/show_plans.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"(Scan|Exchange|Join|HashAggregate|ObjectHashAggregate|SortAggregate|Window|Generate|"
                  r"TakeOrderedAndProject|InMemoryTableScan|ReusedExchange|PushedFilters|ReadSchema)")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    from domus import plans
    from domus.session import build_session
    spark = build_session("local[8]")
    for name, fn in plans.bench_queries().items():
        if only and name not in only:
            continue
        df = fn(spark, sf)
        text = df._jdf.queryExecution().executedPlan().toString()
        print(f"== {name}")
        for line in text.splitlines():
            if KEEP.search(line):
                print("  " + line[:220])


if __name__ == "__main__":
    main()

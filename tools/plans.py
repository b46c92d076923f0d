"""Summarise the executed plans of the headline queries.

Usage: python tools/plans.py [sf_dir] > PLANS.md

Each query runs twice: with the default broadcast threshold, and with
broadcasts off, which is the shape the plan takes when every table is far
above the threshold (the 100 TB case). For each run it counts exchanges,
join and aggregate strategies, and lists every Parquet scan with its read
columns and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = [
    ("shuffle (hash)", r"Exchange hashpartitioning"),
    ("shuffle (range)", r"Exchange rangepartitioning"),
    ("single partition", r"Exchange SinglePartition"),
    ("broadcast", r"BroadcastExchange"),
    ("reused exchange", r"ReusedExchange"),
    ("sort-merge join", r"SortMergeJoin"),
    ("broadcast hash join", r"BroadcastHashJoin"),
    ("hash aggregate", r"HashAggregate"),
    ("sort aggregate", r"SortAggregate"),
    ("expand", r"Expand \["),
    ("window", r"Window \["),
    ("top-k", r"TakeOrderedAndProject"),
    ("parquet scans", r"FileScan parquet"),
]


def final_plan(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    cut = plan.find("== Initial Plan ==")
    return plan[:cut] if cut > 0 else plan


def summarize(name: str, plan: str) -> list[str]:
    out = [f"| {label} | {len(re.findall(rx, plan))} |" for label, rx in OPS]
    scans = re.findall(
        r"FileScan parquet \[([^\]]*)\].*?Location: \w+\([^)]*\)\[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]",
        plan,
    )
    lines = [f"#### {name}", "", "| operator | count |", "| --- | --- |", *out, ""]
    if scans:
        lines += ["| scan | columns read | pushed filters |", "| --- | --- | --- |"]
        for cols, loc, pushed in scans:
            table = os.path.basename(loc.rstrip("/"))
            names = ", ".join(c.split("#")[0] for c in cols.split(","))
            lines.append(f"| {table} | {names} | {pushed or '-'} |")
        lines.append("")
    return lines


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from bench import HEADLINE
    from lendlake.plans.registry import forget, queries
    from lendlake.session import get_session

    spark = get_session(master="local[8]", shuffle_partitions=8)
    qs = queries()
    print("# Executed plans of the headline queries\n")
    print(f"Generated by `tools/plans.py` on `{sf_dir}` (final adaptive plans).\n")
    for threshold, title in (("-1", "broadcasts off (large-table shape)"),
                             ("10485760", "default broadcast threshold")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
        forget()
        print(f"## {title}\n")
        for name in HEADLINE:
            df = qs[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            df.collect()
            print("\n".join(summarize(name, final_plan(df))))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

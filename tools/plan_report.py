"""Physical plan summary of every registered query, as a large cluster
would plan it: static broadcasting is switched off, so only sides proven
small by the library (literal rows, files under the threshold, probed row
counts) are broadcast; AQE may still convert joins at run time.

Usage: python tools/plan_report.py [sf_dir] [--write]

Prints the table; with ``--write`` replaces the table at the end of
PLANS.md (everything from its "| query | shuffles" header on).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    """Counts over the executed plan; an exchange or subquery printed more
    than once (reused at run time) is counted once, by its plan id."""
    seen: dict[str, str] = {}
    for k, pid in re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)[^\n]*?plan_id=(\d+)",
                             plan):
        seen[pid] = re.sub(r"#\d+L?", "", k)
    keys = list(seen.values())
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) [^\n]*?"
                       r"(Inner|LeftOuter|LeftSemi|LeftAnti|RightOuter|FullOuter)", plan)
    aggs = len(set(re.findall(r"HashAggregate\(keys=\[([^\]]+)\], functions=\[(?:partial_[^\]]*)?\], "
                              r"output=\[[^\]]*\]\)\n\s*[+:|\s-]*(?:Project|Filter|Scan|FileScan|"
                              r"BroadcastHashJoin|SortMergeJoin|Sort|LocalTableScan|\*)", plan)))
    return {
        "shuffle_keys": keys,
        "joins": [f"{'BHJ' if j == 'BroadcastHashJoin' else 'SMJ' if j == 'SortMergeJoin' else 'SHJ'}"
                  f" {t}" for j, t in joins],
        "partial_aggs": aggs,
        "global_aggs": plan.count("SinglePartition"),
        "subqueries": len(set(re.findall(r"Subquery subquery#(\d+)", plan))),
    }


def main() -> None:
    from fleetbook.registry import QUERIES
    from fleetbook.session import local_session

    args = [a for a in sys.argv[1:] if a != "--write"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    lines = ["| query | shuffles (hash keys) | joins | partial aggs | global aggs | subqueries |",
             "| --- | --- | --- | --- | --- | --- |"]
    for name, fn in QUERIES.items():
        if name.startswith("stream"):
            continue
        s = summarize(fn(spark, sf)._jdf.queryExecution().executedPlan().toString())
        lines.append(f"| {name} | {len(s['shuffle_keys'])}: {', '.join(s['shuffle_keys']) or '-'} | "
                     f"{', '.join(s['joins']) or '-'} | {s['partial_aggs']} | {s['global_aggs']} | "
                     f"{s['subqueries']} |")
    table = "\n".join(lines) + "\n"
    if "--write" in sys.argv:
        path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                            "PLANS.md")
        text = open(path).read()
        head = text[:text.index("| query | shuffles")]
        with open(path, "w") as f:
            f.write(head + table)
    print(table, end="")


if __name__ == "__main__":
    main()

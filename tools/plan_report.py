"""Write PLANS.md: the executed (AQE final) physical plan shape of every registered query.

Only the final plan is counted, without the initial plan that AQE keeps beside it. Queries that cut
lineage run jobs before the last one; their number is given.

Usage: python tools/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "WindowGroupLimit", "TakeOrderedAndProject",
       "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Generate", "MapInPandas"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tessera.plans import registry
    from tessera.plans.registry import GROUP
    from tessera.plans.session import build_session

    spark = build_session()
    lines = ["# PLANS", "",
             f"Executed physical plans (AQE final) of every registered query at `{sf_dir}`, produced by",
             "`tools/plan_report.py`. Scans list the table, the columns read and the pushed filters, with their number.",
             "Counts are operator nodes in the final plan (`Exchange` = shuffle).", "",
             "| Key | Group | Scans (table: columns read; pushed filters) | Shuffles | Joins | Other | Jobs before |",
             "|---|---|---|---|---|---|---|"]
    registry.load_all()
    for key, fn in registry.QUERIES.items():
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(key, key)
        df = fn(spark, sf_dir)
        before = len(tracker.getJobIdsForGroup(key))
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # run this execution so the adaptive plan is final
        plan = re.sub(r"(?s)\+- == Initial Plan ==.*?(?=\n\S|\Z)", "", qe.executedPlan().toString())
        c = Counter()
        for op in OPS:
            c[op] = len(re.findall(rf"\b{op}\b", plan))
        scans = []
        for m in re.finditer(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan):
            tail = plan[m.end():m.end() + 2000]
            t = re.search(r"/(\w+)\.parquet", tail)
            pf = re.search(r"PushedFilters: \[([^\]]*)\]", tail)
            cols = len([x for x in m.group(1).split(",") if x.strip()])
            pft = pf.group(1).strip() if pf else ""
            scans.append(f"{t.group(1) if t else '?'}: {cols} cols; {pft[:70] if pft else '-'}")
        joins = ", ".join(f"{k} {c[k]}" for k in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
                                                   "BroadcastNestedLoopJoin", "CartesianProduct") if c[k])
        other = ", ".join(f"{k} {c[k]}" for k in ("HashAggregate", "ObjectHashAggregate", "Window", "WindowGroupLimit",
                                                   "TakeOrderedAndProject", "Generate", "MapInPandas") if c[k])
        lines.append(f"| `{key}` | {GROUP.get(key, '')} | {'<br>'.join(f"{n} x {x}" for x, n in sorted(Counter(scans).items())) or '-'} | "
                     f"{c['Exchange']} | {joins or '-'} | {other or '-'} | {before} |")
        print(key, flush=True)
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()

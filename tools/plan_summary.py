"""Summarise the final (post-AQE) physical plan of every batch query.

    python tools/plan_summary.py [/root/testdata/sf0.1] > docs/PLANS.md

Each query is executed once with the ``noop`` sink so AQE settles its plan,
then the plan is reduced to: shuffles, join strategies, aggregate operators,
window group limits, Python nodes, and for every scan the columns read and the
filters pushed into it.
"""

from __future__ import annotations

import re
import sys
import tempfile
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

OPS = (r"Exchange \w+|BroadcastExchange|ReusedExchange|SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
       r"BroadcastNestedLoopJoin|CartesianProduct|HashAggregate|SortAggregate|ObjectHashAggregate|WindowGroupLimit|"
       r"Window|MapInPandas|ArrowEvalPython|BatchEvalPython|Generate|TakeOrderedAndProject")


def summarise(df) -> tuple[Counter, list[str]]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    ops = Counter(re.findall(OPS, plan))
    scans = []
    for m in re.finditer(r"FileScan parquet [^\[]*\[([^\]]*)\][^\n]*?PushedFilters: \[([^\]]*)\]", plan):
        cols = ", ".join(c.split("#")[0] for c in m.group(1).split(","))
        scans.append(f"read [{cols}] pushed [{m.group(2)}]")
    return ops, scans


def main(argv):
    from moodwatch.plans.registry import batch_queries
    from moodwatch.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16, app="plan-summary")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plans-"))
    print(f"# Physical plans at {sf_dir} (local[8], AQE on, final plans)\n")
    print("Counts of plan operators per query; scans list the columns read and the filters pushed to parquet.\n")
    print("| query | shuffles | joins | aggregates / windows | other |")
    print("|---|---|---|---|---|")
    details = []
    for name, fn in sorted(batch_queries().items()):
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        ops, scans = summarise(df)
        shuffles = ", ".join(f"{k.replace('Exchange ', '')}×{v}" for k, v in ops.items()
                             if k.startswith("Exchange ")) or "none"
        joins = ", ".join(f"{k}×{v}" for k, v in ops.items() if "Join" in k or k in ("BroadcastExchange",
                                                                                    "CartesianProduct")) or "none"
        aggs = ", ".join(f"{k}×{v}" for k, v in ops.items() if "Aggregate" in k or k.startswith("Window")) or "none"
        other = ", ".join(f"{k}×{v}" for k, v in ops.items()
                          if k in ("MapInPandas", "ArrowEvalPython", "BatchEvalPython", "Generate",
                                   "TakeOrderedAndProject", "ReusedExchange")) or ""
        print(f"| {name} | {shuffles} | {joins} | {aggs} | {other} |")
        details.append((name, scans))
    print("\n## Scans\n")
    for name, scans in details:
        print(f"- **{name}**: " + ("; ".join(sorted(set(scans))) if scans else "(no parquet scan)"))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

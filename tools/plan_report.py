"""Summarise the executed (final adaptive) physical plan of every registered
query: scans, shuffles, broadcasts, reused exchanges, group limits and
Python nodes. Writes PLANS.md.

Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "scans": r"FileScan |BatchScan ",
    "shuffles": r"Exchange (?:hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "round_robin": r"RoundRobinPartitioning",
    "broadcasts": r"BroadcastExchange",
    "reused": r"ReusedExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "group_limit": r"WindowGroupLimit",
    "python": r"ArrowEvalPython|FlatMapGroupsInPandas|MapInArrow|MapInPandas|FlatMapGroupsInPandasWithState",
    "ckpt_reads": r"Scan ExistingRDD",
}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from driftwood.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    lines = ["# Executed plans", "",
             f"Final adaptive plans of every registered query at `{sf_dir}` on local[8] "
             "(generated by `tools/plan_report.py`). Streaming queries show the batch read "
             "of their sink. Counts are of plan nodes."
             " `ckpt_reads` counts reads of a "
             "reliable checkpoint written by an earlier job of the same query (partial "
             "calls, fitted models); that job's own scan and shuffle "
             "are not in these counts (for the call queries: one scan and one records "
             "shuffle on (key, bucket), plus the narrow carry read for the running-max "
             "rule).", "",
             "| query | " + " | ".join(PATTERNS) + " | pushed filters |",
             "|---|" + "---|" * (len(PATTERNS) + 1)]
    from driftwood.plans import registry
    registry.load_all()
    for name, fn in sorted(registry.QUERIES.items()):
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
        pushed_txt = "; ".join(p[:80] for p in pushed)[:160] or "–"
        lines.append(f"| {name} | " + " | ".join(counts) + f" | {pushed_txt} |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

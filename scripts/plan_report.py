"""Write PLANS.md: the physical shape of every registered result.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md

For each result: scans (columns read, pushed filters), shuffles (by kind),
broadcasts, windows without partitioning, and whether any Python UDF or
Cartesian product appears. Results that run jobs while being built (quantile
refinement, audits, the stream) report the plan of their final DataFrame.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shape(plan: str) -> dict:
    scans = []
    for line in plan.splitlines():
        m = re.search(r"FileScan (\w+) \[([^\]]*)\]", line)
        if not m:
            continue
        cols = [c for c in m.group(2).split(",") if c and "more fields" not in c]
        more = re.search(r"\.\.\. (\d+) more fields", m.group(2))
        if more:
            cols += ["?"] * int(more.group(1))
        f = re.search(r"PushedFilters: \[(.*?)\](?:, |$)", line)
        filters = f.group(1).strip() if f else ""
        scans.append(f"{m.group(1)}: {len(cols)} cols" + (f", pushed [{re.sub(r'#[0-9]+L?', '', filters)[:80]}]" if filters else ""))
    local = len(re.findall(r"LocalTableScan|Scan ExistingRDD", plan))
    exchanges = re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning|RoundRobinPartitioning|REBALANCE)[^\n]*", plan)
    kinds: dict[str, int] = {}
    for e in exchanges:
        kinds[e] = kinds.get(e, 0) + 1
    return {
        "scans": scans,
        "local": local,
        "shuffles": kinds,
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "udf": bool(re.search(r"BatchEvalPython|ArrowEvalPython", plan)),
        "cartesian": bool(re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tripaudit.session import local_session
    from tripaudit.results import load_all

    spark = local_session()
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripaudit-plans-"))
    print("# PLANS\n")
    print(f"Physical plans of the registered results at `{sf}` (generated by `scripts/plan_report.py`).")
    print("`SinglePartition` exchanges only ever carry bounded tables (a global")
    print("aggregate's partial results, or the 24-row / distinct-value tables ranked by")
    print("a window); `hashpartitioning` exchanges follow a partial aggregate.\n")
    print("`local tables` are small driver-built tables (verdicts, audits, bin grids, quantile intervals).\n")
    print("| result | scans (columns read, pushed filters) | local tables | shuffles | broadcasts | sort-merge joins | Python UDF | cartesian |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in ((n, f) for n, (f, _) in load_all().items()):
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        shuffles = ", ".join(f"{k} x{v}" for k, v in s["shuffles"].items()) or "none"
        print(
            f"| `{name}` | {'; '.join(s['scans']) or '-'} | {s['local']} | {shuffles} | {s['broadcasts']} | "
            f"{s['smj']} | {'yes' if s['udf'] else 'no'} | {'yes' if s['cartesian'] else 'no'} |"
        )
    spark.stop()


if __name__ == "__main__":
    main()

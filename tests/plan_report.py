"""Summarize the executed (final, adaptive) physical plan of every query.

    python tests/plan_report.py [sf_dir] > PLANS.md

For each registered query: the exchanges by kind, join strategies, file
scans with their pushed filters, Python-evaluated nodes, window operators
and checkpoint reads.  Nested internal jobs (fits, histograms) are not part
of the final plan; only the plan of the returned DataFrame is shown.
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    ex = collections.Counter()
    for m in re.finditer(r"Exchange (\w+)", plan):
        kind = m.group(1)
        ex["broadcast" if kind.startswith("HashedRelation") or kind.startswith("IdentityBroadcast")
           else kind] += 1
    joins = collections.Counter(re.findall(
        r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)",
        plan))
    scans = re.findall(r"FileScan (\w+) \[[^\]]*\].*?PushedFilters: \[([^\]]*)\]", plan)
    py = collections.Counter(re.findall(
        r"(MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInArrow)", plan))
    return {
        "exchanges": dict(ex), "joins": dict(joins),
        "scans": [(fmt, f or "-") for fmt, f in scans],
        "checkpoint_reads": plan.count("Scan ExistingRDD"),
        "python": dict(py), "windows": len(re.findall(r"\bWindow \[", plan)),
    }


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    import __spark_entry__ as entry
    from questa.session import local_session
    spark = local_session(8)
    print(f"# Executed plans ({sf_dir}, local[8], AQE on)\n")
    print("Generated by `tests/plan_report.py`. Exchanges and joins are those of the final")
    print("adaptive plan of the returned DataFrame. Internal jobs (fits, histograms, offsets,")
    print("checkpoint writes) run before it; a `checkpoint read` is such a written intermediate.")
    print("At this size AQE turns the orders and parts joins into broadcast joins (both sides are a few")
    print("MB). The library itself broadcasts only bounded tables: offsets, counted per-group tables and")
    print("constant maps.\n")
    print("| query | exchanges | joins | parquet scans: pushed filters | ckpt reads | python | windows |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in entry.queries().items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        fmt = lambda d: ", ".join(f"{k}×{v}" for k, v in sorted(d.items())) or "—"
        scans = "; ".join(f"{f}" for _, f in s["scans"]) or "—"
        print(f"| `{name}` | {fmt(s['exchanges'])} | {fmt(s['joins'])} | {scans} | "
              f"{s['checkpoint_reads']} | {fmt(s['python'])} | {s['windows']} |", flush=True)


if __name__ == "__main__":
    main()

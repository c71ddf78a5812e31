"""Summarize a Spark event log: where the stage time goes.

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tests/eventlog_summary.py <that folder> [top]

Reads plain or zstd-compressed event logs (rolling v2 folders included) and
prints jobs/stages/tasks, total task time, and the stages grouped by their
call site, longest first.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def event_files(folder: str) -> list[str]:
    files = [p for p in glob.glob(os.path.join(folder, "**", "*"), recursive=True)
             if os.path.isfile(p) and (os.path.basename(p).startswith("events_")
                                       or os.path.basename(p).startswith("local-"))]
    return sorted(files)


def summarize(folder: str, top: int = 20) -> str:
    jobs = tasks = 0
    task_ms = 0
    stages = []
    for path in event_files(folder):
        for line in _lines(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                jobs += 1
            elif ev == "SparkListenerTaskEnd":
                tasks += 1
                info = e["Task Info"]
                task_ms += info["Finish Time"] - info["Launch Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages.append((si.get("Completion Time", 0) - si.get("Submission Time", 0),
                               si["Stage Name"], si["Number of Tasks"]))
    by_site = collections.defaultdict(lambda: [0, 0, 0])
    for ms, name, n in stages:
        site = name.split(" at ")[-1] if " at " in name else name
        key = f"{name.split(' at ')[0]} @ {site}"
        by_site[key][0] += ms
        by_site[key][1] += 1
        by_site[key][2] += n
    out = [f"jobs {jobs}, stages {len(stages)}, tasks {tasks}, task time {task_ms / 1000:.1f} s, "
           f"stage time {sum(s[0] for s in stages) / 1000:.1f} s"]
    for key, (ms, count, n) in sorted(by_site.items(), key=lambda kv: -kv[1][0])[:top]:
        out.append(f"{ms / 1000:8.2f} s  stages={count:4d}  tasks={n:5d}  {key}")
    return "\n".join(out)


if __name__ == "__main__":
    print(summarize(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 20))

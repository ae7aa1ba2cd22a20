"""Per-query job and stage times from a Spark event log.

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/eventlog_report.py <that folder>

Jobs are attributed to queries through the job group bench.py sets.
For each query: wall time of its jobs, number of stages and tasks, and the
three longest stages with their task counts.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
from collections import defaultdict


def _lines(path):
    if os.path.isdir(path):
        for f in sorted(glob.glob(os.path.join(path, "events_*"))):
            yield from _lines(f)
        return
    raw = open(path, "rb")
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(raw)
    yield from io.TextIOWrapper(raw, encoding="utf-8")


def main(folder: str) -> None:
    logs = [p for p in glob.glob(os.path.join(folder, "*")) if "local-" in p or "app-" in p]
    stages, jobs, stage_group = {}, {}, {}
    for log in logs:
        for line in _lines(log):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                jobs[ev["Job ID"]] = [group, ev["Submission Time"], None]
                for sid in ev["Stage IDs"]:
                    stage_group[sid] = group
            elif kind == "SparkListenerJobEnd" and ev["Job ID"] in jobs:
                jobs[ev["Job ID"]][2] = ev["Completion Time"]
            elif kind == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                if "Completion Time" in si and "Submission Time" in si:
                    stages[si["Stage ID"]] = (si["Stage Name"][:48], si["Number of Tasks"],
                                              (si["Completion Time"] - si["Submission Time"]) / 1000)
    per = defaultdict(lambda: {"job_s": 0.0, "stages": [], "tasks": 0})
    for group, start, end in jobs.values():
        if group and end:
            per[group]["job_s"] += (end - start) / 1000
    for sid, info in stages.items():
        g = stage_group.get(sid)
        if g:
            per[g]["stages"].append(info)
            per[g]["tasks"] += info[1]
    for g, d in sorted(per.items(), key=lambda kv: -kv[1]["job_s"]):
        top = sorted(d["stages"], key=lambda s: -s[2])[:3]
        desc = "; ".join(f"{n} x{t} {s:.2f}s" for n, t, s in top)
        print(f"{g:28s} jobs {d['job_s']:6.2f}s  stages {len(d['stages']):3d}  tasks {d['tasks']:5d}  | {desc}")


if __name__ == "__main__":
    main(sys.argv[1])

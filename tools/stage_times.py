"""Rank the stages of a Spark event log by duration.

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_times.py $BENCH_EVENT_LOG_DIR [top]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def read_events(path: str):
    files = [f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(f)]
    for f in files:
        base = os.path.basename(f)
        if base.startswith(".") or base.startswith("appstatus"):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(open(f, "rb"), read_across_frames=True).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, jobs = {}, 0
    for e in read_events(path):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            jobs += 1
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            ms = si.get("Completion Time", 0) - si.get("Submission Time", 0)
            stages[si["Stage ID"]] = (ms, si["Number of Tasks"], si["Stage Name"][:90])
    print(f"jobs {jobs}  stages {len(stages)}  stage time {sum(v[0] for v in stages.values())} ms")
    for sid, (ms, tasks, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"{sid:6d} {ms:7d} ms {tasks:5d} tasks  {name}")


if __name__ == "__main__":
    main()

"""Summarise a Spark event log: the slowest stages with task counts, summed
executor run time, the slowest task and shuffle records written.

Usage: BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) BENCH_QUERIES=q python bench.py
       python tools/stage_times.py <that folder> [top_n]
Reads plain or zstd-compressed event logs (Spark 4 compresses them by default).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode("utf-8").splitlines()


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, tasks = {}, {}
    for path in sorted(glob.glob(os.path.join(folder, "**", "*"), recursive=True)):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        for line in _lines(path):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                key = (si["Stage ID"], si["Stage Attempt ID"])
                wall = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                stages[key] = (si["Stage Name"][:60], si["Number of Tasks"], wall)
            elif kind == "SparkListenerTaskEnd":
                key = (e["Stage ID"], e["Stage Attempt ID"])
                m = e.get("Task Metrics") or {}
                run = m.get("Executor Run Time", 0)
                written = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
                t = tasks.setdefault(key, [0, 0, 0])
                t[0] += run
                t[1] = max(t[1], run)
                t[2] += written
    print(f"{'stage':>6} {'tasks':>5} {'wall_s':>7} {'cpu_s':>7} {'max_task_s':>10} {'shuffle_w':>10}  name")
    for key, (name, n, wall) in sorted(stages.items(), key=lambda kv: -kv[1][2])[:top]:
        cpu, longest, written = tasks.get(key, [0, 0, 0])
        print(f"{key[0]:>6} {n:>5} {wall:7.2f} {cpu / 1000:7.2f} {longest / 1000:10.2f} {written:>10}  {name}")
    print(f"stages: {len(stages)}, summed stage wall time: {sum(v[2] for v in stages.values()):.2f} s")


if __name__ == "__main__":
    main()

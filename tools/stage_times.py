"""Summarise stage times from a Spark event log (no UI needed).

Usage: python tools/stage_times.py EVENT_LOG_FILE_OR_DIR [N]
Prints the N slowest stages: wall time, task count, summed executor run time
and shuffle read/write bytes. Produce a log with
``BENCH_EVENT_LOG=$(mktemp -d) python bench.py``.
"""

from __future__ import annotations

import json
import os
import sys


def events(path: str):
    """JSON events from a log file, or every event file under a directory
    (Spark 4 writes rolling logs as ``eventlog_v2_*/events_*`` directories)."""
    if os.path.isdir(path):
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                       if not f.startswith(("appstatus", ".")))
    else:
        files = [path]
    for f in files:
        if f.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
            import io

            import zstandard
            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                lines = io.TextIOWrapper(reader, encoding="utf-8")
                for line in lines:
                    yield json.loads(line)
        else:
            with open(f, encoding="utf-8") as fh:
                for line in fh:
                    yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = {}
    for e in events(path):
        if e.get("Event") == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            wall = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
            stages[info["Stage ID"]] = (
                wall, info.get("Number of Tasks", 0), info.get("Stage Name", "")[:60],
                int(acc.get("internal.metrics.executorRunTime", 0) or 0) / 1000,
                int(acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0)
                + int(acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0),
                int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0),
            )
    total = sum(s[0] for s in stages.values())
    print(f"{len(stages)} stages, {total:.1f} s summed stage wall time")
    print(f"{'stage':>6} {'wall s':>7} {'tasks':>6} {'run s':>7} {'shuf rd':>10} {'shuf wr':>10}  name")
    for sid, (wall, n, name, run, rd, wr) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"{sid:>6} {wall:7.2f} {n:6d} {run:7.2f} {rd:10d} {wr:10d}  {name}")


if __name__ == "__main__":
    main()

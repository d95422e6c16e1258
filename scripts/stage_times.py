"""Per-stage task statistics from a Spark event log (no UI needed).

usage: BENCH_EVENT_LOG_DIR=/tmp/ev-XXXX python bench.py
       python scripts/stage_times.py /tmp/ev-XXXX/<app-id> [top]

Prints the stages with the longest tasks: task count, median and maximum
task time, and the max/median ratio (a straggler, e.g. from a hot key,
shows up as a large ratio).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
from collections import defaultdict


def lines(path: str):
    """Event log lines from a single file or a rolling log folder
    (``eventlog_v2_*`` with ``events_<n>_*`` parts, Spark's default now)."""
    if os.path.isdir(path):
        parts = sorted(
            (p for p in os.listdir(path) if p.startswith("events_")),
            key=lambda p: int(p.split("_")[1]),
        )
        files = [os.path.join(path, p) for p in parts]
    else:
        files = [path]
    for f in files:
        if f.endswith(".zstd"):  # Spark compresses event logs with zstd by default
            import io

            import zstandard

            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    durations: dict[tuple[int, int], list[int]] = defaultdict(list)
    names: dict[tuple[int, int], str] = {}
    for line in lines(path):
        if True:
            event = json.loads(line)
            kind = event.get("Event")
            if kind == "SparkListenerTaskEnd":
                info = event["Task Info"]
                key = (event["Stage ID"], event["Stage Attempt ID"])
                durations[key].append(info["Finish Time"] - info["Launch Time"])
            elif kind == "SparkListenerStageCompleted":
                stage = event["Stage Info"]
                names[(stage["Stage ID"], stage["Stage Attempt ID"])] = stage["Stage Name"].split(" at ")[0]
    rows = []
    for key, ds in durations.items():
        med = statistics.median(ds)
        rows.append((max(ds), key, len(ds), med, max(ds) / med if med else float("inf")))
    print(f"{'stage':>8} {'tasks':>6} {'median ms':>10} {'max ms':>8} {'max/med':>8}  name")
    for mx, key, n, med, ratio in sorted(rows, reverse=True)[:top]:
        print(f"{key[0]:>8} {n:>6} {med:>10.0f} {mx:>8} {ratio:>8.1f}  {names.get(key, '')}")


if __name__ == "__main__":
    main()

"""Slowest stages from a Spark event log (written by ``bench.py`` with ``BENCH_EVENT_LOG_DIR``).

Usage: python tools/stage_times.py <event-log-dir> [top_n]
Reads the rolling event-log files (plain or zstd-compressed) and prints the longest stages with their task counts.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(argv):
    root = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 10
    files = sorted(p for p in glob.glob(os.path.join(root, "**", "events_*"), recursive=True))
    stages = []
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                stages.append((dur, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:70]))
    for dur, sid, n, name in sorted(stages, reverse=True)[:top]:
        print(f"stage {sid:>4}  {dur:7.2f}s  tasks {n:>4}  {name}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages):.1f}s total stage time")


if __name__ == "__main__":
    main(sys.argv)

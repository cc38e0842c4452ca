"""Per-stage summary of a Spark event log (no UI needed).

    python scripts/stage_times.py <event log file or folder> [top]

For each completed stage: wall time, task count, slowest task, total shuffle
read/write and records, and the skew ratio (slowest task / median task).
Stages are listed slowest first.
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
from collections import defaultdict


def _open(f):
    """Text lines of an event log part; Spark 4 compresses them with zstd."""
    if f.endswith(".zstd") or f.endswith(".zst"):
        import zstandard
        raw = open(f, "rb")
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    return open(f, encoding="utf-8")


def _files(path):
    """Event log files under ``path`` (Spark 4 writes rolling logs: a folder
    per application with ``events_*`` parts)."""
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in names
                if not n.startswith(".") and not n.startswith("appstatus")]
    return sorted(out)


def summarise(path):
    tasks = defaultdict(list)
    stages = {}
    for f in _files(path):
        with _open(f) as fh:
            for line in fh:
                try:
                    ev = json.loads(line)
                except ValueError:
                    continue
                kind = ev.get("Event")
                if kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    info = ev["Task Info"]
                    sr = m.get("Shuffle Read Metrics", {})
                    sw = m.get("Shuffle Write Metrics", {})
                    tasks[(ev["Stage ID"], ev["Stage Attempt ID"])].append({
                        "ms": info["Finish Time"] - info["Launch Time"],
                        "read": sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0),
                        "read_rec": sr.get("Total Records Read", 0),
                        "write": sw.get("Shuffle Bytes Written", 0),
                    })
                elif kind == "SparkListenerStageCompleted":
                    si = ev["Stage Info"]
                    if si.get("Completion Time") and si.get("Submission Time"):
                        stages[(si["Stage ID"], si["Stage Attempt ID"])] = (
                            si["Completion Time"] - si["Submission Time"], si["Stage Name"][:60])
    rows = []
    for key, (wall, name) in stages.items():
        ts = tasks.get(key, [])
        if not ts:
            continue
        ms = [t["ms"] for t in ts]
        med = statistics.median(ms) or 1
        rows.append((wall, key[0], len(ts), max(ms), max(ms) / med,
                     sum(t["read"] for t in ts), sum(t["read_rec"] for t in ts),
                     sum(t["write"] for t in ts), name))
    return sorted(rows, reverse=True)


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 25
    print(f"{'wall ms':>8} {'stage':>6} {'tasks':>6} {'max ms':>7} {'skew':>5} "
          f"{'read MB':>8} {'read rec':>10} {'write MB':>8}  name")
    for wall, sid, n, mx, skew, rd, rr, wr, name in summarise(path)[:top]:
        print(f"{wall:8d} {sid:6d} {n:6d} {mx:7d} {skew:5.1f} {rd / 2**20:8.1f} {rr:10d} "
              f"{wr / 2**20:8.1f}  {name}")


if __name__ == "__main__":
    main()

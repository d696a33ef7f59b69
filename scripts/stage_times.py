"""Summarise stage times from a Spark event log folder (written with BENCH_EVENT_LOG).

Usage: python scripts/stage_times.py <event-log folder> [top_n]
Prints the slowest stages: duration, task count, shuffle read / write bytes.
"""

from __future__ import annotations

import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def stages(folder: str):
    for root, _, names in os.walk(folder):
        for name in sorted(names):
            if not name.startswith("events_"):
                continue
            for line in _lines(os.path.join(root, name)):
                if line.strip():
                    ev = json.loads(line)
                    if ev.get("Event") != "SparkListenerStageCompleted":
                        continue
                    info = ev["Stage Info"]
                    acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                    read = int(acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0) + \
                        int(acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0)
                    yield {
                        "stage": info["Stage ID"],
                        "name": info["Stage Name"][:60],
                        "tasks": info["Number of Tasks"],
                        "sec": (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000.0,
                        "shuffle_read": read,
                        "shuffle_write": int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0),
                    }


def main(argv: list[str]) -> None:
    rows = sorted(stages(argv[1]), key=lambda r: -r["sec"])
    top = int(argv[2]) if len(argv) > 2 else 20
    print(f"{'stage':>6} {'sec':>7} {'tasks':>6} {'shuf_read':>11} {'shuf_write':>11}  name")
    for r in rows[:top]:
        print(f"{r['stage']:>6} {r['sec']:>7.2f} {r['tasks']:>6} {r['shuffle_read']:>11} {r['shuffle_write']:>11}  {r['name']}")
    print(f"# {len(rows)} stages, {sum(r['sec'] for r in rows):.1f} stage-seconds")


if __name__ == "__main__":
    main(sys.argv)

"""Job timeline from a Spark event log folder (written by bench.py into its
scratch folder): python tools/eventlog.py <eventlog_dir or file> [from_s] [to_s]"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

import zstandard


def events(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for name in files:
        raw = open(name, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if name.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            if line.strip():
                yield json.loads(line)


def main() -> None:
    import signal

    signal.signal(signal.SIGPIPE, signal.SIG_DFL)
    path = sys.argv[1]
    lo = float(sys.argv[2]) if len(sys.argv) > 2 else 0.0
    hi = float(sys.argv[3]) if len(sys.argv) > 3 else 1e9
    jobs, stages, t0 = {}, {}, None
    for e in events(path):
        kind = e["Event"]
        if kind == "SparkListenerApplicationStart":
            t0 = e["Timestamp"]
        elif kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            jobs[e["Job ID"]] = {
                "start": e["Submission Time"],
                "site": props.get("callSite.short", ""),
                "stages": e["Stage IDs"],
            }
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            took = info["Completion Time"] - info["Submission Time"] if info.get("Submission Time") else 0
            stages[info["Stage ID"]] = (info.get("Number of Tasks"), took / 1000, info.get("Stage Name", "")[:40])
    t0 = t0 or min(j["start"] for j in jobs.values())
    for jid, job in sorted(jobs.items()):
        at = (job["start"] - t0) / 1000
        if not lo <= at <= hi:
            continue
        took = (job.get("end", job["start"]) - job["start"]) / 1000
        parts = [stages[s] for s in job["stages"] if s in stages]
        print(f"job {jid:4d} at {at:8.2f}s took {took:6.2f}s  {job['site'][:45]:45s} stages(tasks,s)={parts}")


if __name__ == "__main__":
    main()

"""Summarise a Spark event log (uncompressed): jobs per description with
wall time, task count and executor CPU.

    python tools/stage_times.py <event-log-file>
"""

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as fh:
                data = zstandard.ZstdDecompressor().stream_reader(fh).read()
            yield from io.StringIO(data.decode())
        else:
            yield from open(f)


def main(path: str, detail: str | None = None) -> None:
    jobs, stages = {}, {}
    for line in _lines(path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description") or "-"
            infos = e.get("Stage Infos") or []
            name = infos[-1]["Stage Name"] if infos else ""
            jobs[e["Job ID"]] = {"desc": desc, "stages": e["Stage IDs"], "t0": e["Submission Time"],
                                 "name": name}
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["ms"] = e["Completion Time"] - jobs[e["Job ID"]]["t0"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            acc = {a["Name"]: a.get("Value") for a in si.get("Accumulables", [])}
            stages[si["Stage ID"]] = (si["Number of Tasks"],
                                      int(acc.get("internal.metrics.executorCpuTime", 0) or 0) // 10**6)
    if detail:
        for j in sorted(jobs):
            d = jobs[j]
            if d["desc"] == detail:
                tasks = sum(stages[s][0] for s in d["stages"] if s in stages)
                cpu = sum(stages[s][1] for s in d["stages"] if s in stages)
                print(f"job {j:4d} {d.get('ms', 0):7d} ms tasks {tasks:4d} cpu {cpu:6d} "
                      f"{d.get('name', '')[:60]}")
        return
    per = collections.OrderedDict()
    for j in sorted(jobs):
        d = jobs[j]
        agg = per.setdefault(d["desc"], [0, 0, 0, 0])
        agg[0] += 1
        agg[1] += d.get("ms", 0)
        for s in d["stages"]:
            if s in stages:
                agg[2] += stages[s][0]
                agg[3] += stages[s][1]
    print(f"{'step':32} {'jobs':>5} {'wall ms':>9} {'tasks':>6} {'cpu ms':>8}")
    for k, (n, ms, tasks, cpu) in per.items():
        print(f"{k[:32]:32} {n:5d} {ms:9d} {tasks:6d} {cpu:8d}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else None)

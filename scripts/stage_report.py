"""Per-stage task statistics of the headline queries, from Spark's event log.

Runs each query once with the event log written to a fresh scratch folder
(no UI, no server), then summarises every stage: tasks, median and max task
time (a max far above the median flags a straggler / skew), input bytes and
shuffle bytes written. Output: docs/STAGES.md.

usage: python scripts/stage_report.py [--sf DIR] [names...]
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.plans import registry  # noqa: E402
from quire.session import build_session  # noqa: E402


def _lines(log_path):
    files = sorted(glob.glob(f"{log_path}/events_*")) if os.path.isdir(log_path) else [log_path]
    for f in files:
        yield from open(f)


def parse(log_path):
    jobs, stages, tasks = {}, {}, {}
    for line in _lines(log_path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            jobs[e["Job ID"]] = {"group": props.get("spark.jobGroup.id"), "stages": e.get("Stage IDs", [])}
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = {"name": si.get("Stage Name", ""), "n": si.get("Number of Tasks")}
        elif ev == "SparkListenerTaskEnd":
            ti, tm = e["Task Info"], e.get("Task Metrics") or {}
            d = tasks.setdefault(e["Stage ID"], {"dur": [], "in": 0, "sw": 0, "sr": 0})
            d["dur"].append(ti["Finish Time"] - ti["Launch Time"])
            d["in"] += (tm.get("Input Metrics") or {}).get("Bytes Read", 0)
            d["sw"] += (tm.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            sr = tm.get("Shuffle Read Metrics") or {}
            d["sr"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
    return jobs, stages, tasks


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--warm", action="store_true", help="run each query once before the measured run")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    logdir = tempfile.mkdtemp(prefix="quire-eventlog-")
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true",
                                                 "spark.eventLog.dir": f"file://{logdir}",
                                                 "spark.eventLog.compress": "false"})
    registry.load_all()
    names = a.names or list(registry.BENCH)
    secs = {}
    for n in names:
        if a.warm:
            spark.sparkContext.setJobGroup(f"warm-{n}", "warm-up")
            registry.QUERIES[n](spark, a.sf).write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobGroup(n, n)
        t0 = time.perf_counter()
        registry.QUERIES[n](spark, a.sf).write.format("noop").mode("overwrite").save()
        secs[n] = time.perf_counter() - t0
    spark.stop()
    log = sorted(glob.glob(f"{logdir}/*"))[-1]
    jobs, stages, tasks = parse(log)
    out = ["# Stage report", "",
           f"`scripts/stage_report.py` on `{a.sf}`, local[8], one {'warm' if a.warm else 'cold'} run per query "
           "(event log in a scratch folder). Times in ms; bytes in KiB. `max/median` far above 1 would flag a "
           "straggler.", ""]
    for n in names:
        sids = sorted({s for j in jobs.values() if j["group"] == n for s in j["stages"] if s in tasks})
        out += [f"## {n} ({secs[n]:.2f} s wall)", "",
                "| stage | tasks | median ms | max ms | input KiB | shuffle write KiB | shuffle read KiB |",
                "|---|---|---|---|---|---|---|"]
        for s in sids:
            t = tasks[s]
            med = statistics.median(t["dur"]) if t["dur"] else 0
            out.append(f"| {s} | {len(t['dur'])} | {med:.0f} | {max(t['dur']) if t['dur'] else 0} | "
                       f"{t['in'] // 1024} | {t['sw'] // 1024} | {t['sr'] // 1024} |")
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "STAGES.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main()

"""Stage-level profile of registered queries from Spark's event log.

    python tools/stage_profile.py [--sf DIR] name [name ...]

Writes the event log to a fresh scratch folder (no UI, no server) and prints,
per query, the slowest stages with their task counts and the operators they ran.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--top", type=int, default=8)
    ap.add_argument("names", nargs="+")
    args = ap.parse_args()
    logdir = tempfile.mkdtemp(prefix="nightaudit-eventlog-")
    from pyspark.sql import SparkSession

    from nightaudit.session import SCALE_CONF, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "16")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
         .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    from nightaudit.registry import REGISTRY
    marks = []
    for name in args.names:
        REGISTRY[name](spark, args.sf).write.format("noop").mode("overwrite").save()  # warm
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        REGISTRY[name](spark, args.sf).write.format("noop").mode("overwrite").save()
        marks.append((name, time.time() - t0))
        spark.sparkContext.setJobGroup("", "")
    spark.stop()
    stages, job_group, task_ms = {}, {}, {}
    for f in [p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(p)]:
        for line in open(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    job_group[sid] = g
            elif ev == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                task_ms[e["Stage ID"]] = task_ms.get(e["Stage ID"], 0) + m.get("Executor Run Time", 0)
            elif ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
                rdds = [r.get("Name", "") for r in info.get("RDD Info", [])]
                stages[info["Stage ID"]] = (dur, info.get("Number of Tasks"), info.get("Stage Name", ""), rdds)
    for name, total in marks:
        mine = sorted(((task_ms.get(k, 0) / 1000, v, k) for k, v in stages.items() if job_group.get(k) == name),
                      reverse=True)
        print(f"== {name}: {total:.2f}s wall, {len(mine)} stages, task time sum {sum(m[0] for m in mine):.2f}s")
        for cpu, (dur, ntasks, sname, rdds), sid in mine[:args.top]:
            ops = ",".join(sorted({r.split(" ")[0] for r in rdds if r}))[:80]
            print(f"   stage {sid:4d} task {cpu:6.2f}s wall {dur:5.2f}s tasks={ntasks:4d} | {ops}")


if __name__ == "__main__":
    main()

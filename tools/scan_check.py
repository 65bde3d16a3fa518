"""How many times does each query read the fact table?

Runs queries on the materialised star with Spark's event log written to a
fresh scratch folder, then sums the records read by the tasks of each query
and divides by the fact's row count. 1.0 means one scan of the fact.
Usage: python tools/scan_check.py [sf_dir] [name,name,...]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main() -> None:
    from tallystar.plans import warehouse_job
    from tallystar.plans.registry import load_all
    from tallystar.session import local_session

    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names_arg = [a for a in args if not a.startswith("/")]
    registry = load_all()
    names = names_arg[0].split(",") if names_arg else list(registry)
    log_dir = tempfile.mkdtemp(prefix="tallystar-eventlog-")
    spark = local_session(8, shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false"})
    target = warehouse_job.build(spark, sf)
    fact_rows = spark.read.parquet(target + "/fact_sales").count()
    sc = spark.sparkContext
    for n in names:
        sc.setJobGroup(n, n)
        t0 = time.perf_counter()
        registry[n].build(spark, sf).write.format("noop").mode("overwrite").save()
        print(f"{n}: {time.perf_counter() - t0:.2f}s")
    spark.stop()
    stage_group, records = {}, {}
    for path in (f for f in glob.glob(log_dir + "/**", recursive=True) if os.path.isfile(f)):
        for line in open(path, errors="replace"):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for s in e["Stage IDs"]:
                    stage_group[s] = g
            elif e["Event"] == "SparkListenerTaskEnd":
                g = stage_group.get(e["Stage ID"])
                m = (e.get("Task Metrics") or {}).get("Input Metrics") or {}
                records[g] = records.get(g, 0) + m.get("Records Read", 0)
    for n in names:
        print(f"{n:40s} fact scans {records.get(n, 0) / fact_rows:5.2f}")


if __name__ == "__main__":
    main()

"""Benchmark the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Like the reference's flow, the star schema is built (timed as
``warehouse_build``: the lineitem x orders x part join written as parquet to
the checkpoint folder) and every query then reads those tables. Each query
and the build are executed to completion (queries through the ``noop`` sink,
no collect); the first run warms up and the median of the next
``$BENCH_REPEAT`` runs (default 3) is reported. ``cold_warehouse_build`` is
the first build including JVM warm-up; ``fact_build`` scans the written copy,
``fact_build_without_copy`` runs the join (outside the total).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "fact_build", "sales_by_hour", "sales_by_meal_period", "sales_heatmap", "menu_ranking",
    "category_performance", "size_performance", "size_mix_by_category", "upsell_scenarios",
    "order_size_distribution", "audit_date_coverage", "audit_duplicates",
    "pair_lift", "daily_sales_correlation", "cannibalisation_candidates",
    "daily_series", "gap_fill_dow_median", "decompose", "kruskal_weekday",
    "staffing_plan",
]


def main() -> None:
    from tallystar.plans import warehouse_job
    from tallystar.plans.registry import load_all
    from tallystar.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    spark = local_session(cpus, shuffle_partitions=max(cpus * 2, 8), app_name="tallystar-bench")
    registry = load_all()

    times: dict[str, float] = {}
    runs = []
    for _ in range(repeat + 1):              # first build also warms up the JVM
        t0 = time.perf_counter()
        warehouse_job.build(spark, sf_dir)
        runs.append(time.perf_counter() - t0)
    times["warehouse_build"] = round(statistics.median(runs[1:]), 3)
    cold_build = round(runs[0], 3)

    for name in names:
        runs = []
        for _ in range(repeat + 1):          # first run warms up caches/codegen
            t = time.perf_counter()
            registry[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        times[name] = round(statistics.median(runs[1:]), 3)

    # The same fact without the written copy: the join of lines, orders and SKUs itself.
    warehouse_job.forget(spark, sf_dir)
    runs = []
    for _ in range(repeat + 1):
        t = time.perf_counter()
        registry["fact_build"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - t)
    lazy = round(statistics.median(runs[1:]), 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total_median_sec", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
           "cpus": cpus, "repeat": repeat, "cold_warehouse_build": cold_build, "fact_build_without_copy": lazy}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

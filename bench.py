"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query runs its whole plan into the ``noop`` sink (every row is
produced, nothing is collected to the driver). One warm-up run of the
whole decision chain primes the JVM; each headline query is then timed
$BENCH_REPEAT times (default 3) and its median reported. ``value`` is the
sum of the medians.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "prepare_transactions", "master_sales", "demand_analytics", "inventory_analytics",
    "dynamic_pricing", "inventory_optimization", "build_catalog", "generate_inventory",
    "quality_report", "validation_report", "profile_table", "clean_clickstream",
    "clean_competitor", "realtime_pricing",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE

    from shelfwise.plans.queries import QUERIES
    from shelfwise.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(cpus, 8), app_name="shelfwise-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("dynamic_pricing")  # warm-up: the whole decision chain, once (JIT, footers)
    timings = {}
    for name in names:
        timings[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

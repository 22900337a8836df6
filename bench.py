"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs after one warm-up, default 3; each includes the plan build), BENCH_QUERIES (comma
list to restrict).  Each query is executed in full through the ``noop``
sink (nothing is collected to the driver).  Prints one JSON line.
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
    "asof_join",            # J-01 backward as-of join
    "sensor_features",      # T-02 lag + 7-row rolling means
    "latest_state",         # T-04 whole E1 chain to the latest state per aircraft
    "health_union",         # T-08 + U-01 nine-rule health and union
    "features_fuel",        # W-08 component features on lineitem
    "component_map",        # T-12 alerts per airport
    "unified_alerts",       # T-13 alert mart
    "traceability",         # T-14 alert → inference
    "alert_summary",        # A-03
    "status_map",           # T-07
    "sanity_row",           # P-17
    "dedupe_latest",        # W-02
    "keyed_upsert",         # O-07
    "fleet_summary",        # Q-01
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from fleetlens.plans.catalog import queries
    from fleetlens.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="fleetlens-bench")
    qs = queries()
    results = {}
    for name in (only or HEADLINE):
        fn = qs[name]
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
                      "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] (default 4); each run builds the DataFrame and executes
the whole plan into the ``noop`` sink (nothing collected). Every query gets one
untimed warm-up run (JIT and code generation for its plan shape), then the
median of $BENCH_REPEATS timed runs (default 3) is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitalflow.plans.catalog import QUERIES  # noqa: E402
from vitalflow.session import build_session  # noqa: E402

HEADLINE = [
    "dedup_batch",          # grouped dedup of the landing table
    "bronze_quarantine",    # dedup + rule routing + reasons
    "eligibility",          # flagship gold table
    "kpis_by_bu",           # flagship KPI table
    "violation_counts",     # 11 quality checks
    "whatif_threshold",     # threshold sweep
    "whatif_params",        # scenario KPIs
    "stream_messages",      # notifier texts (directory join + formatting)
    "quarantine_stats",     # reject reasons per sport and day
    "cdc_timestamps",       # CDC decode path
    "stream_route",         # streaming ingest: land, decode, watermark dedup, route, write (availableNow)
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(f"local[{cpus}]", app="vitalflow-bench", shuffle_partitions=max(cpus, 4),
                          extra={"spark.driver.memory": "8g"})
    timings = {}
    for name in HEADLINE:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up, untimed
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus, "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()

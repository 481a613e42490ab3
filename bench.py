"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
reports; ``queries`` has every timing and ``total_sec`` their sum.  Each
query runs to completion through the ``noop`` sink (full computation, no
collection to the driver), after one warm-up run of the whole set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_temperatures",
    "fact_city_airport",
    "dim_airport",
    "dim_demographics",
    "report_city_climate",
    "report_city_veterans",
    "join_star_report",
    "dq_duplicates",
    "influence_correlation",
    "pipeline_end_to_end",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from climastar.plans.catalog import QUERIES
    from climastar.session import local_session

    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="climastar-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # The reports as the source job runs them: over the written tables
    from climastar.plans.catalog import model
    from climastar.plans.model import read_model, write_model
    from climastar.plans.reports import report_city_climate, report_city_veterans
    from climastar.session import new_run_dir

    stored_dir = new_run_dir(spark, "bench-model")
    write_model(model(spark, sf_dir), stored_dir)

    def run_stored(report) -> float:
        t0 = time.perf_counter()
        report(read_model(spark, stored_dir)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    stored = {"report_city_climate@stored": report_city_climate,
              "report_city_veterans@stored": report_city_veterans}

    for name in HEADLINE:      # warm-up: JIT, file listing caches
        run(name)
    for fn in stored.values():
        run_stored(fn)
    timings = {}
    for name in HEADLINE:
        samples = sorted(run(name) for _ in range(runs))
        timings[name] = round(samples[len(samples) // 2], 3)
    for name, fn in stored.items():
        samples = sorted(run_stored(fn) for _ in range(runs))
        timings[name] = round(samples[len(samples) // 2], 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "report_city_climate_over_written_tables_median_sec",
        "value": timings["report_city_climate@stored"],
        "unit": "sec",
        "queries": timings,
        "total_sec": round(sum(timings.values()), 3),
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

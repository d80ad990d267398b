"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the `noop` sink (every row is produced,
nothing is shipped to the driver), after one warm-up run of the adapter scan.
`etl_two_loads` stages the measurements as landing CSV files and runs the
whole load path twice (morning, then afternoon load, merging into the stored
roll-up); the `stored_*` queries then read the partitioned tables it wrote,
and `stream_*` run the ingestion stream and the streaming roll-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from measures.plans import catalog  # noqa: E402
from measures.session import build_session  # noqa: E402

HEADLINE = ("daily_rollup", "rollup_merge_faithful", "rollup_merge_exact", "enrollments",
            "q1_quality_by_study", "q1_quality_by_study_rollup", "q2_trend", "q2_trend_rollup",
            "q3_counts_by_site", "q3_counts_by_site_rollup", "q4_low_quality", "q5_recent",
            "q6_participants", "q7_mean_bmi", "q7_mean_bmi_rollup", "r1_measurements",
            "r2_study", "range_report")
AFTER_LOAD = ("etl_rollup", "etl_jobs", "etl_job_status", "stored_q1_quality_by_study",
              "stored_q1_quality_by_study_rollup", "stored_q2_trend_rollup",
              "stored_q3_counts_by_site_rollup", "stored_q4_low_quality", "stored_q5_recent",
              "stored_q6_participants", "stored_q7_mean_bmi", "stored_q7_mean_bmi_rollup",
              "stored_r1_measurements", "stored_r2_study", "stream_ingest_facts",
              "stream_daily_rollup")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", app="measures-bench",
                          shuffle_partitions=cpus, extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    run(catalog.q_facts(spark, sf_dir))  # warm-up: JIT, file listing, first scan
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(catalog.QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    catalog.loaded_store(spark, sf_dir)
    times["etl_two_loads"] = round(time.perf_counter() - t0, 3)
    for name in AFTER_LOAD:
        t0 = time.perf_counter()
        run(catalog.QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()

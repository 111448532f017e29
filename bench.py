"""Time the queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and print one JSON line.

Each query runs once to warm up; then the median of the timed runs counts. The result of a run
goes to the noop sink, so every row and column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from ratelake.plans.queries import QUERIES

HEADLINE = (
    "rate_summary_by_code",
    "rate_messages",
    "procedure_rate_upsert",
    "provider_rate_fact",
    "rate_provider_join",
    "serve_by_plan_code",
    "serve_by_zip",
    "toc_good_plans",
    "toc_first_rank",
    "toc_file_plans",
    "toc_child_jobs",
    "plan_upsert",
    "job_counters",
    "job_latest_status",
    "job_step_durations",
    "parse_metrics",
    "file_manifest",
    "zip_expand",
    "shred_items",
    "stream_job_counters",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE))
    chosen = list(QUERIES) if names == "all" else names.split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ratelake-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in chosen:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(name, [round(t, 2) for t in taken], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

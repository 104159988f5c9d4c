"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES``
optionally a comma-separated choice. Every query runs once to warm up, then ``RUNS`` times, and the
median counts. Results are written to the no-op sink, so that all columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from verification import registry

RUNS = 2
HEADLINES = (
    "quality_combined_from_files",
    "silver_audit",
    "silver_events",
    "duplicate_summary",
    "price_quantiles_approx",
    "price_outliers_exact",
    "events_per_hour",
    "funnel_sessions",
    "funnel_by_month",
    "funnel_by_utc_weekday_hour",
    "top_purchase_categories",
    "purchases_by_category_day",
    "session_examples",
    "score_confusion",
    "slice_kpis",
    "conversion_grid",
    "five_v_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_FOLDER", "/tmp/clickloom-bench"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    builders = registry.queries()
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            builders[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

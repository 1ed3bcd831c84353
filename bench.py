"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and is then timed once, its result forced with the `noop` sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegauge.operators.scale import clear_staging  # noqa: E402
from tidegauge.plans.catalogue import load  # noqa: E402

HEADLINE = (
    "event_type_summary", "log_rollup", "error_rate", "top_users", "category_summary", "region_category_pivot",
    "manager_join", "sales_report", "box_plot", "null_rates", "quality_snapshot", "winsorize_bounds", "clean_a",
    "clean_b", "clean_c", "quantiles_linear", "validate_records", "products_flat", "ingest_route", "dlq_records",
    "psi", "ks", "js", "drift_table", "root_cause", "welch_t", "chi_square", "stratified_split", "weighted_resample",
    "attempt_outcomes", "congestion", "concurrency_trace", "auc_rank", "period_metrics", "stream_counts",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidegauge-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", os.environ.get("BENCH_STAGING") or tempfile.mkdtemp(prefix="tidegauge-bench-"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in only or HEADLINE:
        run = load()[name].run
        for timed in (False, True):
            start = time.perf_counter()
            run(spark, folder).write.format("noop").mode("overwrite").save()
            if timed:
                seconds[name] = round(time.perf_counter() - start, 3)
            clear_staging(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()

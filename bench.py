"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tidemark.queries import QUERIES
from tidemark.session import RECOMMENDED

HEADLINE = [
    "eligible_years",
    "year_profile",
    "condition_breakdown",
    "excl_custom_sql",
    "excl_combined",
    "dry_run_plan",
    "archive_create",
    "archive_create_custom_sql",
    "archive_append",
    "archive_live",
    "source_after_delete",
    "resume_delete",
    "delete_plan",
    "restore_year",
    "restore_unified",
    "slice_wipe",
    "slice_rollback",
    "late_arrivals",
    "verify_fingerprint",
    "latest_status",
    "open_runs",
    "resolve_actions",
    "rollback_gates",
    "scan_summary",
    "config_merge",
    "dryrun_drift",
    "dryrun_rollup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["dry_run_plan"](spark, sf_dir).collect()  # start-up is not part of any query
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

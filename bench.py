"""Time the headline queries; prints one JSON line after each query, the last of which holds all of them.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.  Each query runs once to warm up and
then ``BENCH_RUNS`` times (median reported; once if the warm-up took longer than ``LONG`` seconds); results go to Spark's no-op sink, so every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from registry.queries import QUERIES  # noqa: E402

HEADLINE = [
    "ingest_transactions",
    "flatten_analytics",
    "date_parts_iso",
    "dedupe_users",
    "curate_users",
    "trans_type_counts",
    "trans_profile",
    "curate_transactions",
    "anti_join_new_users",
    "analytics_latest",
    "surrogate_key_dense",
    "date_dim",
    "user_dim",
    "trans_dim",
    "analytics_dim",
    "gmv_per_month",
    "partitioned_roundtrip",
    "profile_fact",
    "star_report",
    "day_partition_refresh",
    "incremental_new_rows",
    "key_audit",
    "full_load_fact",
    "incremental_load_fact",
]

# Seconds beyond which a query is run once more and no further.
LONG = 20


def report(seconds: dict[str, float], folder: str) -> None:
    """The figures so far: one slow query never costs those of the others."""
    total = round(sum(seconds.values()), 3)
    line = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}
    print(json.dumps(line), flush=True)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerlake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="ledgerlake-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        while len(times) < (2 if times and times[0] > LONG else runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name:28} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
        report(seconds, folder)
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

Every query runs once to warm up and then three times; the median counts. A
run includes building the plan and computing all rows and columns.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "staged_amounts", "quarantine_split", "ingest_counts", "staged_statuses", "parse_ts_multi", "row_hashes",
    "rule_violations", "ownership_check", "latest_per_key", "earliest_per_key_attr", "current_row_join",
    "pit_join", "pit_join_small", "pit_join_fallback", "fact_initial", "fact_incremental", "insert_if_absent",
    "scd2_initial", "scd2_change_detect", "scd2_history", "scd2_merge", "hwm_extract", "new_batches",
    "partition_pruned_scan", "ledger_latest", "change_feed", "dim_date", "star_initial_counts",
]
ONCE = {"star_initial_counts"}


def run(spark, name: str, path: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        rounds = 1 if name in ONCE else 3
        if rounds > 1:
            run(spark, name, path)
        times[name] = round(statistics.median(run(spark, name, path) for _ in range(rounds)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(path.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

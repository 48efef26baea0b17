"""Seconds per headline query: one JSON line on stdout.

Each query runs once to warm up; the better of two further runs counts. Every run computes all rows and
writes them to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tierweave.plans.queries import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "revenue_daily",
    "cancellation_summary",
    "refund_loss",
    "train_performance",
    "revenue_by_route_week",
    "event_milestones",
    "nth_event",
    "ticket_derivations",
    "ticket_lookups",
    "asof_passenger",
    "asof_train",
    "silver_tickets",
    "scd1_snapshot",
    "scd2_merge",
    "scd2_expire_and_open",
    "fact_upsert",
    "fact_fold",
    "aggregate_upsert",
    "dq_suite_tickets",
    "dq_suite_revenue_daily",
    "warehouse_revenue",
)


def run(spark: SparkSession, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(spark, name)
        seconds[name] = round(min(run(spark, name) for _ in range(2)), 3)
    line = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8)
choose the data and the cores. Every query is run to the end, all columns, into a
sink that discards the rows. ``--all`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from siltgate_queries.registry import REGISTRY  # noqa: E402

HEADLINE = [
    "dedup_first_seen",
    "silver_customers",
    "quarantine_customers",
    "silver_orders",
    "quarantine_orders",
    "silver_movements",
    "quarantine_movements",
    "layer_summary",
    "check_uniqueness",
    "check_referential_integrity",
    "dq_metrics_single_pass",
    "stage_events",
    "stage_lead_times",
    "d2d_lead_times",
    "e2e_lead_times",
    "kpi_summary",
    "dq_results_table",
    "dq_results_lead_time",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = list(REGISTRY) if "--all" in sys.argv else HEADLINE
    spark = session()
    REGISTRY["silver_customers"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

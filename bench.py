"""Times headline queries and prints one JSON line.

Each query is timed with its inputs, the stored layer tables, already there; what it
takes to land and build those is reported on its own. Results are consumed whole, by a
write to the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.crosscheck import inputs
from millrace.crosscheck.queries import QUERIES, curated, first_state, first_target, merged_state
from millrace.feeds import FEEDS
from millrace.session import build_session

HEADLINE = (
    "stg_customers",
    "stg_cdr",
    "stg_payments",
    "stg_customers_merge",
    "stg_payments_merge",
    "stg_billing_merge",
    "stg_cdr_insert_absent",
    "cdc_customers",
    "cdc_support_tickets",
    "dim_customer_scd2",
    "fact_payments",
    "fact_support_tickets",
    "fact_cdr_usage",
    "surrogate_keys",
    "monthly_summary",
    "monthly_summary_north",
    "revenue_monthly",
    "usage_daily",
    "masked_customers_analyst_global",
    "masked_cdr",
    "pii_inventory",
    "dq_summary_cdr",
    "dq_errors_payments",
    "dq_staging_checks",
    "run_log",
    "daily_run_stats",
    "latest_run_status",
    "raw_load_customers",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"}
    spark = build_session("bench", f"local[{cpus}]", {**conf, "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    started = time.perf_counter()
    for feed in FEEDS.values():
        inputs.raw_rows(spark, folder, feed)
    land = time.perf_counter() - started
    for feed in FEEDS.values():
        first_state(spark, folder, feed)
        merged_state(spark, folder, feed)
        if feed.target.kind == "upsert":
            first_target(spark, folder, feed)
    curated(spark, folder)
    build = time.perf_counter() - started - land

    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(2):
            begun = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - begun
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best of two",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
                "land_seconds": round(land, 3),
                "build_layers_seconds": round(build, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

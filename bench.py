"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and
cores. A query is timed from building the plan to the last row of its result,
written to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from stresslake.plans import catalog

HEADLINE = [
    "agg_transaction_stress", "agg_liquidity_stress", "agg_loan_exposure",
    "agg_intraday_position", "stress_totals_transactions", "stress_totals_loans",
    "combined_metrics", "combined_metrics_rollup",
    "fx_convert_transactions", "fx_convert_loans", "fx_convert_feed_rates",
    "scenario_expand_loans", "dedup_rows", "duplicate_keys",
    "validate_silver", "validate_gold", "null_metrics", "duplicate_metrics",
    "semantic_types", "format_validity", "column_statistics", "quality_report",
    "kpi_cards", "kpi_daily_trend", "kpi_scenario_pivot",
    "ingest_latest_snapshot", "layer_roundtrip", "report_export",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the session's code paths on the smallest query, outside the timing.
    catalog.QUERIES["default_region"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the input folder (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
``refine_and_model`` is the time to check, split and write all silver tables and to build and write
the whole star schema; the other queries read those written tables or the raw input.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conformance import mapping, registry  # noqa: E402
from conformance.workspace import workspace  # noqa: E402

HEADLINE = [
    "bronze_audit_transactions", "dq_rules_transactions", "silver_transactions", "quarantine_transactions",
    "dq_foreign_keys", "unique_flags_transactions", "reconcile_layers",
    "scd2_customer", "asof_customer_version", "upsert_accounts", "latest_transactions", "insert_only_transactions",
    "fact_transactions", "fact_payments", "agg_daily_balances", "agg_monthly_summary", "agg_branch_performance",
    "agg_customer_360", "vw_branch_performance", "vw_customer_risk_profile", "vw_daily_txn_summary",
    "vw_payment_channel_analysis", "q_quarterly", "q_star_join_top5", "q_top10_customers", "q_customer360_risk",
    "q_filtered_branch_year", "anomaly_daily_counts", "failure_burst", "alerts_thresholds",
]

# A whole nightly run with bronze, quarantine, rule outcomes and warehouse, and two incremental loads; timed and
# reported, but not part of the total, which stays comparable over rounds.
WHOLE_RUNS = ["nightly_run_log", "incremental_merge_customers"]


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-bench-"))
        .getOrCreate()
    )


def run(df: DataFrame) -> None:
    """Work out every row and column without keeping the result."""
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    # One small query first, so that no timing contains the start of the JVM.
    run(mapping.source(spark, sf_dir, "branches"))

    tables = workspace(spark, sf_dir)

    def refine_and_model() -> None:
        tables.all_gold()

    seconds = {"refine_and_model": timed(refine_and_model)}
    queries = registry.queries()
    for name in HEADLINE:
        seconds[name] = timed(lambda n=name: run(queries[n](spark, sf_dir)))
    total = round(sum(seconds.values()), 3)
    for name in WHOLE_RUNS:
        seconds[name] = timed(lambda n=name: run(queries[n](spark, sf_dir)))
    found = re.search(r"sf([0-9.]+)$", sf_dir.rstrip("/"))
    result = {
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1)) if found else None,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

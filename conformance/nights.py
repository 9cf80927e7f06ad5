"""Nights over the given tables: a first load, then late, corrected and repeated rows, moved customers and a renamed branch."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conformance import mapping
from conformance.workspace import CALENDAR, Workspace
from tellerlake.operators.skew import keyed_join
from tellerlake.plans import nightly
from tellerlake.plans.continuous import run_incremental_night
from tellerlake.plans.incremental import incremental_run, read_merged
from tellerlake.plans.reprocessing import reprocess_quarantine
from tellerlake.session import scratch_path
from tellerlake.sources.lake import Lake

# These texts mean the same in Spark SQL and DuckDB, as those of the mapping do.
LATE = "o_orderkey % 10 = 3 AND o_orderdate >= date '2000-09-01'"
FIXED = "o_orderkey % 5 = 2 AND o_orderdate >= date '2000-06-01' AND o_orderdate < date '2000-08-01'"
_AMOUNT = "cast(o_totalprice as decimal(18,2))"
CORRECTED = {
    "amount": f"case when {FIXED} then cast({_AMOUNT} * 2 as decimal(18,2)) else {_AMOUNT} end",
    "txn_timestamp": f"case when {FIXED} and o_orderkey % 2 = 0 then cast(cast(o_orderdate as date) + 65 as timestamp) else cast(o_orderdate as timestamp) end",
}
RENAMED = {"branch_name": "case when n_nationkey = 3 then 'Renamed' when n_nationkey%5=0 then concat(' ',n_name) else n_name end"}
# Rows that claim to be from the far future.
AHEAD = {"txn_timestamp": "case when o_orderkey % 500 = 1 then cast(date '2999-01-01' as timestamp) else cast(o_orderdate as timestamp) end"}
# Accounts of a first attempt of a date, half of them with a balance that breaks a rule.
SPOILT = {"balance": "case when c_custkey % 2 = 0 then cast(-1 as decimal(18,2)) else cast(c_acctbal as decimal(18,2)) end"}

_LOOKBACK = timedelta(days=500)
_made: dict[tuple[int, str], object] = {}


def orders(w: Workspace, changes: dict[str, str] | None = None, where: str = "true") -> DataFrame:
    rows = mapping.read(w.spark, w.sf_dir, "orders").filter(where).selectExpr(*mapping.columns("transactions", changes))
    return rows.withColumn("txn_timestamp", F.col("txn_timestamp").cast("timestamp"))


def _two_nights(w: Workspace) -> tuple[Lake, dict[str, DataFrame], set[str]]:
    """The lake, its gold tables, and the parts of the fact that the second night wrote."""
    lake = Lake(w.spark, scratch_path(w.spark, "nights"))
    fact = lake.parts("gold", "fact_transactions")
    first = {t: w.source(t) for t in mapping.TABLES} | {"transactions": orders(w, where=f"NOT ({LATE})")}
    run_incremental_night(lake, first, "2025-03-01", CALENDAR, False, _LOOKBACK, "month", 8)
    before = fact.entry()
    region = mapping.read(w.spark, w.sf_dir, "region")
    nations = mapping.read(w.spark, w.sf_dir, "nation").join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    second = first | {
        "transactions": orders(w, CORRECTED),
        "customers": w.source("customers").filter("customer_id % 10 <> 1").unionByName(mapping.moved_customers(w.spark, w.sf_dir)),
        "branches": nations.selectExpr(*mapping.columns("branches", RENAMED)).withColumn("created_at", F.col("created_at").cast("timestamp")),
    }
    gold = run_incremental_night(lake, second, "2025-03-02", CALENDAR, False, _LOOKBACK, "month", 8)
    written = {part for part, _, _ in set(fact.entry().folders) - set(before.folders)}
    return lake, gold, written


def two_nights(w: Workspace) -> tuple[Lake, dict[str, DataFrame], set[str]]:
    key = (id(w), "nights")
    if key not in _made:
        _made[key] = _two_nights(w)
    return _made[key]


def second_run(w: Workspace) -> DataFrame:
    """The transaction fact after two nights, by natural keys."""
    _, gold, _ = two_nights(w)
    out = gold["fact_transactions"]
    for dim, sk, key in (("dim_account", "account_sk", "account_id"), ("dim_customer", "customer_sk", "customer_id"), ("dim_branch", "branch_sk", "branch_code")):
        out = keyed_join(out, gold[dim].filter("is_current = 1").select(sk, key), [sk])
    return out.select("txn_id", "account_id", "customer_id", "branch_code", "date_sk", "amount", "debit_amount", "credit_amount", "txn_date", "status")


def second_customers(w: Workspace) -> DataFrame:
    _, gold, _ = two_nights(w)
    known = gold["dim_customer"].filter("is_current = 1").select("customer_sk", "customer_id", F.col("branch_code").alias("home_branch"))
    return keyed_join(gold["agg_customer_360"], known, ["customer_sk"], spread=False).drop("customer_sk")


def written_parts(w: Workspace) -> DataFrame:
    """Every month of the fact and whether the second night wrote it."""
    lake, gold, written = two_nights(w)
    months = gold["fact_transactions"].groupBy(F.date_format("txn_date", "yyyy-MM").alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    return months.withColumn("written", F.col("part").isin(*written).cast("int"))


def future_row(w: Workspace) -> DataFrame:
    """Two loads of the transactions, the first with rows of the year 2999: nothing behind them is lost."""
    lake = Lake(w.spark, scratch_path(w.spark, "future"))
    ahead = orders(w, AHEAD)
    incremental_run(lake, "transactions", ahead.filter("txn_timestamp < timestamp '2000-01-01' OR txn_timestamp > timestamp '2900-01-01'"), "b1", datetime(2025, 3, 1))
    incremental_run(lake, "transactions", ahead, "b2", datetime(2025, 3, 2))
    return read_merged(lake, "transactions").select("txn_id", "amount", "txn_timestamp")


def rerun(w: Workspace) -> DataFrame:
    """Rows of each zone after a date was loaded with broken accounts and then again with good ones."""
    lake = Lake(w.spark, scratch_path(w.spark, "rerun"))
    spoilt = mapping.read(w.spark, w.sf_dir, "customer").selectExpr(*mapping.columns("accounts", SPOILT))
    spoilt = spoilt.withColumns({c: F.col(c).cast("timestamp") for c in ("created_at", "updated_at")})
    for number, rows in enumerate((spoilt, w.source("accounts"))):
        run = nightly.Run(lake, datetime(2025, 3, 1), f"attempt-{number}", [])
        nightly.ingest(run, "accounts", rows)
        nightly.refine(run, "accounts", halt=False)
    zones = [lake.read(z, "accounts").agg(F.count(F.lit(1)).alias("rows"), F.min("batch_id").alias("batch_id")).withColumn("zone", F.lit(z)) for z in ("bronze", "silver", "quarantine")]
    return zones[0].unionByName(zones[1]).unionByName(zones[2])


def reprocessed(w: Workspace) -> DataFrame:
    """Accounts of silver and quarantine after negative balances were raised to 0: where each is, and as what."""
    lake = Lake(w.spark, scratch_path(w.spark, "reprocessed"))
    run = nightly.Run(lake, datetime(2025, 3, 1), "first", [])
    nightly.ingest(run, "accounts", w.source("accounts"))
    nightly.refine(run, "accounts", halt=False)
    later = nightly.Run(lake, datetime(2025, 3, 2), "second", [])
    reprocess_quarantine(later, "accounts", lambda df: df.withColumn("balance", F.greatest("balance", F.lit(0).cast("decimal(18,2)"))))
    silver = lake.read("silver", "accounts").select("account_id", "balance", "dq_status", F.lit("silver").alias("zone"))
    return silver.unionByName(lake.read("quarantine", "accounts").select("account_id", "balance", "dq_status", F.lit("quarantine").alias("zone")))

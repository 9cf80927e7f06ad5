"""Pre-aggregates of the transaction fact.

Distinct counts are taken by grouping in steps (first by the finer key, then by the coarser one):
every step combines rows before its shuffle, so a branch or customer with a third of all rows only
sends one row per task and finer key.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.measures import mean2
from tellerlake.operators.skew import SHUFFLED, keyed_join
from tellerlake.plans.dims import columns_of

# Content of agg_type.
AGG_TYPES = {
    "agg_daily_balances": "DAILY_BALANCE",
    "agg_monthly_summary": "MONTHLY_SUMMARY",
    "agg_branch_performance": "BRANCH_PERFORMANCE",
    "agg_customer_360": "CUSTOMER_360",
}


def roll(df: DataFrame, keys: list[str], sums: list[str], maxima: list[str] = [], minima: list[str] = []) -> DataFrame:
    """Group and combine partial measures under their own names."""
    return df.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxima], *[F.min(c).alias(c) for c in minima]
    )


def transaction_measures(fact: DataFrame) -> DataFrame:
    """Fact columns under the names of the measures they start."""
    one = F.lit(1).cast("bigint")
    return fact.select(
        "branch_sk", "customer_sk", "account_sk", "txn_date",
        F.col("amount").alias("volume"), F.col("credit_amount").alias("credits"), F.col("debit_amount").alias("debits"),
        F.when(F.col("txn_id").isNotNull(), one).otherwise(0).alias("txns"),
        F.col("amount").alias("largest"), F.col("txn_date").alias("first_date"), F.col("txn_date").alias("last_date"),
        (F.col("status") == "SUCCESS").cast("bigint").alias("succeeded"),
        (F.col("status") == "FAILED").cast("bigint").alias("unsuccessful"),
    )


SUMS = ["volume", "credits", "debits", "txns"]
SPANS = {"maxima": ["largest", "last_date"], "minima": ["first_date"]}


def finish(df: DataFrame, table: str, run_ts: datetime) -> DataFrame:
    stamped = df.withColumns(
        {"gold_load_ts": F.lit(run_ts).cast("timestamp"), "agg_type": F.lit(AGG_TYPES[table])}
    )
    return stamped.select(*columns_of(table))


def agg_daily_balances(fact: DataFrame, dim_account: DataFrame, run_ts: datetime) -> DataFrame:
    return daily_rows(roll(transaction_measures(fact), ["account_sk", "txn_date"], SUMS), dim_account, run_ts)


def daily_rows(days: DataFrame, dim_account: DataFrame, run_ts: datetime) -> DataFrame:
    """Aggregate rows of measures rolled up to account and day."""
    named = keyed_join(days, dim_account.select("account_sk", "account_id"), ["account_sk"], spread=False)
    out = named.withColumns(
        {
            "total_credit": F.col("credits"),
            "total_debit": F.col("debits"),
            "net_balance_change": F.col("credits") - F.col("debits"),
            "txn_count": F.col("txns"),
            "avg_txn_amount": mean2(F.col("volume"), F.col("txns")),
        }
    )
    return finish(out, "agg_daily_balances", run_ts)


def agg_monthly_summary(fact: DataFrame, dim_branch: DataFrame, run_ts: datetime) -> DataFrame:
    months = transaction_measures(fact).withColumn("year_month", F.date_format("txn_date", "yyyy-MM"))
    return monthly_rows(roll(months, ["branch_sk", "year_month", "account_sk"], SUMS), dim_branch, run_ts)


def monthly_rows(accounts: DataFrame, dim_branch: DataFrame, run_ts: datetime) -> DataFrame:
    """Aggregate rows of measures rolled up to branch, month and account."""
    return named_months(accounts.withColumn("active_accounts", F.lit(1).cast("bigint")), dim_branch, run_ts)


def monthly_cells(cells: DataFrame, dim_branch: DataFrame, run_ts: datetime) -> DataFrame:
    """:func:`monthly_rows` of measures in finer cells: sums and accounts are taken apart, so that accounts are shuffled without sums."""
    keys = ["branch_sk", "year_month"]
    sums = roll(cells, keys, SUMS).withColumn("active_accounts", F.lit(0).cast("bigint"))
    accounts = cells.select(*keys, "account_sk").distinct().select(
        *keys, *[F.lit(None).cast(sums.schema[c].dataType).alias(c) for c in SUMS], F.lit(1).cast("bigint").alias("active_accounts")
    )
    return named_months(sums.unionByName(accounts), dim_branch, run_ts)


def named_months(counted: DataFrame, dim_branch: DataFrame, run_ts: datetime) -> DataFrame:
    """Aggregate rows of measures and numbers of accounts (active_accounts) per branch and month."""
    per_month = roll(counted, ["branch_sk", "year_month"], [*SUMS, "active_accounts"])
    named = keyed_join(per_month, dim_branch.select("branch_sk", "branch_code", "branch_name"), ["branch_sk"], spread=False)
    out = named.withColumns(
        {
            "total_txn_volume": F.col("volume"),
            "total_txn_count": F.col("txns"),
            "total_credits": F.col("credits"),
            "total_debits": F.col("debits"),
            "avg_txn_amount": mean2(F.col("volume"), F.col("txns")),
        }
    )
    return finish(out, "agg_monthly_summary", run_ts)


def agg_branch_performance(fact: DataFrame, dim_branch: DataFrame, run_ts: datetime) -> DataFrame:
    """Per branch. Accounts are counted per customer first: an account has one customer."""
    return branch_rows(roll(transaction_measures(fact), ["branch_sk", "customer_sk", "account_sk"], SUMS, **SPANS), dim_branch, run_ts)


def branch_rows(accounts: DataFrame, dim_branch: DataFrame, run_ts: datetime) -> DataFrame:
    """Aggregate rows of measures rolled up to branch, customer and account."""
    customers = roll(
        accounts.withColumn("accounts", F.lit(1).cast("bigint")), ["branch_sk", "customer_sk"], [*SUMS, "accounts"], **SPANS
    )
    branches = roll(
        customers.withColumn("customers", F.lit(1).cast("bigint")), ["branch_sk"], [*SUMS, "accounts", "customers"], **SPANS
    )
    named = keyed_join(branches, dim_branch.select("branch_sk", "branch_code", "branch_name", "city", "region"), ["branch_sk"])
    out = named.withColumns(
        {
            "total_txn_volume": F.col("volume"),
            "total_txn_count": F.col("txns"),
            "avg_txn_amount": mean2(F.col("volume"), F.col("txns")),
            "max_single_txn": F.col("largest"),
            "first_txn_date": F.col("first_date"),
            "last_txn_date": F.col("last_date"),
            "unique_accounts": F.col("accounts"),
            "unique_customers": F.col("customers"),
        }
    )
    return finish(out, "agg_branch_performance", run_ts)


def agg_customer_360(fact: DataFrame, run_ts: datetime) -> DataFrame:
    """Per customer; accounts and days are counted in two narrow passes instead of a row expansion."""
    rows = transaction_measures(fact)
    accounts = roll(rows, ["customer_sk", "account_sk"], SUMS, **SPANS)
    days = rows.select("customer_sk", "txn_date").distinct().groupBy("customer_sk").agg(F.count("txn_date").alias("days"))
    return customer_rows(accounts, days, run_ts)


def customer_rows(accounts: DataFrame, days: DataFrame, run_ts: datetime) -> DataFrame:
    """Aggregate rows of measures rolled up to customer and account, and the days of each customer."""
    totals = roll(accounts.withColumn("accounts", F.lit(1).cast("bigint")), ["customer_sk"], [*SUMS, "accounts"], **SPANS)
    joined = totals.join(days.hint(SHUFFLED), "customer_sk")
    out = joined.withColumns(
        {
            "lifetime_txn_volume": F.col("volume"),
            "lifetime_txn_count": F.col("txns"),
            "avg_txn_amount": mean2(F.col("volume"), F.col("txns")),
            "total_credits_received": F.col("credits"),
            "total_debits_made": F.col("debits"),
            "largest_single_txn": F.col("largest"),
            "first_txn_date": F.col("first_date"),
            "last_txn_date": F.col("last_date"),
            "active_days": F.col("days"),
            "num_accounts": F.col("accounts"),
        }
    )
    return finish(out, "agg_customer_360", run_ts)

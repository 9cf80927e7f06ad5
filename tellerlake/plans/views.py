"""Analytical views over the star schema.

Facts are reduced by their surrogate keys first; the dimensions then join the reduced rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.banding import bank_risk_category
from tellerlake.functions.measures import failed, mean2, pct
from tellerlake.operators.joins import current, join_dim
from tellerlake.operators.skew import fanout_join, keyed_join
from tellerlake.plans.aggregates import roll, transaction_measures
from tellerlake.session import settle_keys


def vw_branch_performance(fact: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Volume, customers and accounts per branch.

    Distinct counts are taken in steps, account by account; an account has one customer.
    """
    sums = ["volume", "credits", "debits", "txns", "succeeded", "unsuccessful"]
    accounts = roll(
        transaction_measures(fact), ["branch_sk", "customer_sk", "account_sk"], sums, ["last_date"], ["first_date"]
    )
    attrs = ["branch_code", "branch_name", "city", "state", "region"]
    # Branch versions with the same attributes are one row of the view: they go by their first key.
    same = dim_branch.groupBy(*attrs).agg(F.min("branch_sk").alias("place"))
    on_attrs = reduce(Column.__and__, [dim_branch[c].eqNullSafe(same[c]) for c in attrs])
    place_of = settle_keys(dim_branch.join(same, on_attrs).select("branch_sk", "place"))
    placed = join_dim(accounts, place_of, "branch_sk")

    one = F.lit(1).cast("bigint")
    spans = (["last_date"], ["first_date"])
    per_account = roll(placed, ["place", "customer_sk", "account_sk"], sums, *spans).withColumn("accounts", one)
    per_customer = roll(per_account, ["place", "customer_sk"], [*sums, "accounts"], *spans).withColumn("customers", one)
    per_place = roll(per_customer, ["place"], [*sums, "accounts", "customers"], *spans)
    named = per_place.join(same, "place")
    return named.select(
        *attrs,
        F.col("txns").alias("total_transactions"),
        F.col("volume").alias("total_volume_inr"),
        mean2(F.col("volume"), F.col("txns")).alias("avg_txn_amount_inr"),
        F.col("credits").alias("total_credits_inr"),
        F.col("debits").alias("total_debits_inr"),
        F.col("customers").alias("unique_customers"),
        F.col("accounts").alias("unique_accounts"),
        F.col("first_date").alias("first_txn_date"),
        F.col("last_date").alias("last_txn_date"),
        F.col("succeeded").alias("successful_txns"),
        F.col("unsuccessful").alias("failed_txns"),
    )


def vw_customer_risk_profile(
    dim_customer: DataFrame,
    dim_branch: DataFrame,
    fact_credit_risk: DataFrame,
    agg_customer_360: DataFrame,
    latest_only: bool = False,
) -> DataFrame:
    """One row per current customer and bureau pull, or per customer with ``latest_only``."""
    pulls = fact_credit_risk.filter(F.col("customer_sk") != 0).select(
        "customer_sk", "credit_score", "risk_grade", "risk_band",
        "external_active_loans", "external_overdue_amount", "bureau_pull_date",
    )
    if latest_only:
        row = F.max_by(F.struct(*pulls.columns), F.col("bureau_pull_date"))
        pulls = pulls.groupBy("customer_sk").agg(row.alias("r")).select("r.*")
    people = current(dim_customer).select(
        "customer_sk", "customer_id", "first_name", "last_name", "kyc_status", "branch_sk"
    )
    placed = keyed_join(people, dim_branch.select("branch_sk", "branch_name", "city"), ["branch_sk"])
    lifetime = agg_customer_360.select(
        "customer_sk", "lifetime_txn_volume", "lifetime_txn_count", "num_accounts", "last_txn_date"
    )
    known = placed.join(lifetime, "customer_sk", "left")
    rows = known.join(pulls, "customer_sk", "left") if latest_only else fanout_join(known, pulls, ["customer_sk"])
    return rows.select(
        "customer_id", "first_name", "last_name", "kyc_status", "branch_name", "city",
        "credit_score", "risk_grade", "risk_band", "external_active_loans", "external_overdue_amount",
        "bureau_pull_date", "lifetime_txn_volume", "lifetime_txn_count", "num_accounts", "last_txn_date",
        bank_risk_category(F.col("credit_score")).alias("bank_risk_category"),
    )


def vw_daily_txn_summary(fact: DataFrame, dim_date: DataFrame, dim_branch: DataFrame) -> DataFrame:
    keys = ["date_sk", "branch_sk", "txn_type", "channel"]
    cells = fact.groupBy(*keys).agg(
        F.count("txn_id").alias("n"),
        F.sum("amount").alias("total"),
        F.min("amount").alias("low"),
        F.max("amount").alias("high"),
        F.count_if(F.col("status") == "SUCCESS").alias("ok"),
        F.count_if(F.col("status") == "FAILED").alias("bad"),
    )
    day = ["full_date", "day_name", "month_name", "year", "quarter", "is_weekend", "fiscal_quarter"]
    place = ["branch_name", "region"]
    dated = join_dim(cells, dim_date.select("date_sk", *day), "date_sk", spread=False)
    placed = join_dim(dated, dim_branch.select("branch_sk", *place), "branch_sk", spread=False)
    return placed.groupBy(*day, *place, "txn_type", "channel").agg(
        F.sum("n").alias("txn_count"),
        F.sum("total").alias("total_amount_inr"),
        mean2(F.sum("total"), F.sum("n")).alias("avg_amount_inr"),
        F.min("low").alias("min_amount_inr"),
        F.max("high").alias("max_amount_inr"),
        F.sum("ok").alias("success_count"),
        F.sum("bad").alias("fail_count"),
    )


def vw_payment_channel_analysis(fact_payments: DataFrame, dim_date: DataFrame) -> DataFrame:
    keys = ["gateway_name", "device_type", "geo_location"]
    cells = fact_payments.groupBy("date_sk", *keys).agg(
        F.count("payment_sk").alias("n"),
        F.sum("is_success").alias("ok"),
        F.sum("processing_time_ms").alias("ms"),
        F.count("processing_time_ms").alias("timed"),
        F.min("processing_time_ms").alias("fastest"),
        F.max("processing_time_ms").alias("slowest"),
    )
    day = ["full_date", "month_name", "year"]
    dated = join_dim(cells, dim_date.select("date_sk", *day), "date_sk", spread=False)
    total, ok = F.sum("n"), F.sum("ok")
    return dated.groupBy(*day, *keys).agg(
        total.alias("total_payments"),
        ok.alias("successful_payments"),
        failed(total, ok).alias("failed_payments"),
        pct(ok, total).alias("success_rate_pct"),
        mean2(F.sum("ms"), F.sum("timed")).cast("double").alias("avg_processing_ms"),
        F.min("fastest").alias("min_processing_ms"),
        F.max("slowest").alias("max_processing_ms"),
    )


def build_views(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All four views by name."""
    branch = gold["dim_branch"]
    return {
        "vw_branch_performance": vw_branch_performance(gold["fact_transactions"], branch),
        "vw_customer_risk_profile": vw_customer_risk_profile(
            gold["dim_customer"], branch, gold["fact_credit_risk"], gold["agg_customer_360"]
        ),
        "vw_daily_txn_summary": vw_daily_txn_summary(gold["fact_transactions"], gold["dim_date"], branch),
        "vw_payment_channel_analysis": vw_payment_channel_analysis(gold["fact_payments"], gold["dim_date"]),
    }

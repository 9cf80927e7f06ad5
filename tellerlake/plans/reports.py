"""Named reports over the gold tables (Q5 to Q25 of the blueprint).

Every report takes the gold tables by name. Facts are reduced before they meet a dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.measures import pct
from tellerlake.operators.aggregates import distribution, distribution_avg, kpi, row_counts, top_k
from tellerlake.operators.joins import current, join_dim, star_join
from tellerlake.plans.views import vw_branch_performance, vw_daily_txn_summary, vw_payment_channel_analysis

Gold = Mapping[str, DataFrame]


def _volume(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(F.sum("amount").alias("volume"), F.count("txn_id").alias("txns"))


def quarterly_amount(gold: Gold, year: int) -> DataFrame:
    """Q5: amount per quarter of a year."""
    dates = gold["dim_date"].filter(F.col("year") == year).select("date_sk", "year", "quarter")
    per_day = join_dim(_volume(gold["fact_transactions"], "date_sk"), dates, "date_sk", spread=False)
    return per_day.groupBy("year", "quarter").agg(F.sum("volume").alias("total_amount"))


def branch_volume(gold: Gold) -> DataFrame:
    """Q6: transactions and volume by branch and city, largest first."""
    branch = gold["dim_branch"].select("branch_sk", "branch_name", "city")
    placed = join_dim(_volume(gold["fact_transactions"], "branch_sk"), branch, "branch_sk", spread=False)
    sums = placed.groupBy("branch_name", "city").agg(
        F.sum("txns").alias("txn_count"), F.sum("volume").alias("total_volume")
    )
    return sums.orderBy(F.desc("total_volume"), "branch_name")


def risk_by_band(gold: Gold) -> DataFrame:
    """Q7: bureau rows and average score by band."""
    return distribution_avg(gold["fact_credit_risk"], "risk_band", "credit_score").orderBy(F.desc("count"), "risk_band")


def gateway_success(gold: Gold) -> DataFrame:
    """Q8: success rate by gateway."""
    n, ok = F.count("payment_sk"), F.sum("is_success")
    return (
        gold["fact_payments"].groupBy("gateway_name")
        .agg(n.alias("total_payments"), ok.alias("successful"), pct(ok, n).alias("success_rate_pct"))
        .orderBy(F.desc("success_rate_pct"), "gateway_name")
    )


def top_customers(gold: Gold, k: int = 10) -> DataFrame:
    """Q9: customers with the largest lifetime volume."""
    people = gold["dim_customer"].select("customer_sk", "customer_id", "full_name")
    totals = gold["agg_customer_360"].select("customer_sk", "lifetime_txn_volume", "lifetime_txn_count")
    joined = totals.join(people, "customer_sk").drop("customer_sk")
    return top_k(joined, "lifetime_txn_volume", k, ["customer_id"])


def table_rows(gold: Gold) -> DataFrame:
    """Q10: rows of every table."""
    return row_counts(dict(gold)).orderBy("table_name")


def star_top_branches(gold: Gold, k: int = 5) -> DataFrame:
    """Q11: branches by volume over a join to date, branch and customer."""
    cells = _volume(gold["fact_transactions"], "branch_sk", "date_sk", "customer_sk")
    dims = {
        "branch_sk": gold["dim_branch"].select("branch_sk", "branch_name"),
        "date_sk": gold["dim_date"].select("date_sk"),
        "customer_sk": gold["dim_customer"].select("customer_sk"),
    }
    sums = star_join(cells, dims, spread=False).groupBy("branch_name").agg(
        F.sum("txns").alias("txn_count"), F.sum("volume").alias("total_volume")
    )
    return top_k(sums, "total_volume", k, ["branch_name"])


def top_view_branches(gold: Gold, k: int = 3) -> DataFrame:
    """Q12: first rows of the branch view."""
    view = vw_branch_performance(gold["fact_transactions"], gold["dim_branch"])
    return top_k(view.select("branch_name", "total_volume_inr", "total_transactions"), "total_volume_inr", k, ["branch_name"])


def kyc_distribution(gold: Gold) -> DataFrame:
    """Q13: current customers by KYC status."""
    return distribution(current(gold["dim_customer"]), "kyc_status").orderBy(F.desc("count"), "kyc_status")


def channel_breakdown(gold: Gold) -> DataFrame:
    """Q14: transactions and amount by channel."""
    return _volume(gold["fact_transactions"], "channel").select(
        "channel", F.col("txns").alias("txn_count"), F.col("volume").alias("total_amount")
    ).orderBy(F.desc("txn_count"), "channel")


def customers_with_city(gold: Gold, k: int = 5) -> DataFrame:
    """Q15: first customers with the city of their branch."""
    branch = gold["dim_branch"].select("branch_sk", "branch_name", "city")
    people = current(gold["dim_customer"]).select("customer_id", "full_name", "branch_sk")
    return join_dim(people, branch, "branch_sk").drop("branch_sk").orderBy("customer_id").limit(k)


def customer_value_by_risk(gold: Gold, k: int = 10) -> DataFrame:
    """Q16: transaction value of current customers with each of their risk bands."""
    spend = _volume(gold["fact_transactions"].filter("customer_sk != 0"), "customer_sk")
    people = current(gold["dim_customer"]).select("customer_sk", "customer_id")
    valued = spend.join(people, "customer_sk")
    bands = gold["fact_credit_risk"].filter("customer_sk != 0").select("customer_sk", "risk_band").distinct()
    rows = valued.join(bands, "customer_sk", "left").select(
        "customer_id", "risk_band", F.col("volume").alias("total_transaction_value"), F.col("txns").alias("transaction_count")
    )
    return top_k(rows, "total_transaction_value", k, ["customer_id", "risk_band"])


def daily_trend(gold: Gold) -> DataFrame:
    """Q17: amount per day out of the daily summary view."""
    view = vw_daily_txn_summary(gold["fact_transactions"], gold["dim_date"], gold["dim_branch"])
    return view.groupBy("full_date").agg(F.sum("total_amount_inr").alias("total_amount")).orderBy("full_date")


def branch_chart(gold: Gold) -> DataFrame:
    """Q18: volume by branch out of the branch view."""
    view = vw_branch_performance(gold["fact_transactions"], gold["dim_branch"])
    return view.groupBy("branch_name").agg(F.sum("total_volume_inr").alias("total_volume")).orderBy(F.desc("total_volume"), "branch_name")


def headline_kpis(gold: Gold) -> DataFrame:
    """Q19: number and amount of transactions, and of debits and credits."""
    return kpi(
        gold["fact_transactions"],
        {
            "total_transactions": F.count(F.lit(1)),
            "total_volume": F.sum("amount"),
            "total_debits": F.sum("debit_amount"),
            "total_credits": F.sum("credit_amount"),
        },
    )


def risk_band_counts(gold: Gold) -> DataFrame:
    """Q20: bureau rows by band."""
    return distribution(gold["fact_credit_risk"], "risk_band")


def gateway_performance(gold: Gold) -> DataFrame:
    """Q21: the payment view rolled up to gateways."""
    view = vw_payment_channel_analysis(gold["fact_payments"], gold["dim_date"])
    n, ok = F.sum("total_payments"), F.sum("successful_payments")
    return view.groupBy("gateway_name").agg(
        n.alias("total_payments"),
        ok.alias("successful_payments"),
        F.sum("failed_payments").alias("failed_payments"),
        pct(ok, n).alias("success_rate_pct"),
        F.max("max_processing_ms").alias("max_processing_ms"),
    )


def weekend_volume(gold: Gold) -> DataFrame:
    """Q22: weekdays against weekends."""
    dates = gold["dim_date"].select("date_sk", "is_weekend")
    per_day = join_dim(_volume(gold["fact_transactions"], "date_sk"), dates, "date_sk", spread=False)
    return per_day.groupBy("is_weekend").agg(F.sum("txns").alias("txn_count"), F.sum("volume").alias("total_amount"))


def filtered_summary(gold: Gold, branch_name: str, year: int) -> DataFrame:
    """Q23: daily summary of one branch and year; the fact is cut to the days of the year.

    ``txn_date`` is filtered as well as the calendar, so the scan can skip row groups.
    """
    dates = gold["dim_date"].filter(F.col("year") == year)
    branch = gold["dim_branch"].filter(F.col("branch_name") == branch_name)
    first, after = F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))
    fact = gold["fact_transactions"].filter((F.col("txn_date") >= first) & (F.col("txn_date") < after))
    return vw_daily_txn_summary(fact, dates, branch)


def excellent_customers(gold: Gold, k: int = 5) -> DataFrame:
    """Q24: first bureau rows of the best band."""
    rows = gold["fact_credit_risk"].filter(F.col("risk_band") == "EXCELLENT")
    return rows.select("customer_id", "bureau_pull_date", "credit_score", "risk_band").orderBy("customer_id", "bureau_pull_date").limit(k)


def branch_performance_ranked(gold: Gold) -> DataFrame:
    """Q25: the branch aggregate ordered by volume."""
    return gold["agg_branch_performance"].select(
        "branch_code", "branch_name", "total_txn_volume", "total_txn_count"
    ).orderBy(F.desc("total_txn_volume"), "branch_code")


REPORTS: dict[str, Callable[..., DataFrame]] = {
    "q_quarterly": quarterly_amount,
    "q_branch_volume": branch_volume,
    "q_risk_band": risk_by_band,
    "q_gateway_rate": gateway_success,
    "q_top10_customers": top_customers,
    "q_row_counts": table_rows,
    "q_star_join_top5": star_top_branches,
    "q_view_top3": top_view_branches,
    "q_kyc": kyc_distribution,
    "q_channel": channel_breakdown,
    "q_customer_city": customers_with_city,
    "q_customer360_risk": customer_value_by_risk,
    "q_daily_trend": daily_trend,
    "q_branch_chart": branch_chart,
    "q_kpi": headline_kpis,
    "q_risk_band_counts": risk_band_counts,
    "q_gateway_table": gateway_performance,
    "q_weekend": weekend_volume,
    "q_filtered_branch_year": filtered_summary,
    "q_excellent": excellent_customers,
    "q_branch_ranked": branch_performance_ranked,
}

"""Fact builders. Rows are numbered on the silver table before any join, then looked up."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.operators.joins import current, join_date, lookup_sk
from tellerlake.operators.keys import assign_sk
from tellerlake.operators.merge import new_rows
from tellerlake.plans.dims import columns_of, stamp
from tellerlake.session import settle


def _amount_if(kind: str) -> Column:
    return F.when(F.col("txn_type") == kind, F.col("amount")).otherwise(F.lit(0).cast("decimal(18,2)"))


def build_fact_transactions(
    silver: DataFrame, dim_account: DataFrame, dim_date: DataFrame, run_ts: datetime, start: int = 0
) -> DataFrame:
    """One row per transaction. Customer and branch are those of the account, so that within the
    fact an account key always comes with the same customer and branch key."""
    return transaction_rows(assign_sk(silver, ["txn_id"], "txn_sk", start), dim_account, dim_date, run_ts)


def transaction_rows(numbered: DataFrame, dim_account: DataFrame, dim_date: DataFrame, run_ts: datetime, more: Sequence[str] = ()) -> DataFrame:
    """Fact rows of silver rows that have their number already, with ``more`` of the columns of these."""
    rows = numbered.withColumns(
        {
            "txn_date": F.to_date("txn_timestamp"),
            "debit_amount": _amount_if("Debit"),
            "credit_amount": _amount_if("Credit"),
        }
    )
    owned = lookup_sk(rows, current(dim_account), ["account_id"], ["account_sk", "customer_sk", "branch_sk"])
    dated = join_date(owned, dim_date, "txn_date")
    return stamp(dated, run_ts).select(*columns_of("fact_transactions"), *more)


def extend_fact_transactions(
    fact: DataFrame, silver: DataFrame, dim_account: DataFrame, dim_date: DataFrame, run_ts: datetime
) -> DataFrame:
    """Fact rows of a load that are not in the fact yet, numbered after the highest key.

    They are to be appended: the existing fact is read for its ids only and never rewritten.
    """
    fresh = settle(new_rows(fact.select("txn_id"), silver, ["txn_id"], ["txn_timestamp"]), "fresh")
    top = fact.agg(F.max("txn_sk")).first()[0] or 0
    return build_fact_transactions(fresh, dim_account, dim_date, run_ts, start=top)


def build_fact_payments(silver: DataFrame, dim_date: DataFrame, run_ts: datetime) -> DataFrame:
    return payment_rows(assign_sk(silver, ["txn_id"], "payment_sk"), dim_date, run_ts)


def payment_rows(numbered: DataFrame, dim_date: DataFrame, run_ts: datetime, more: Sequence[str] = ()) -> DataFrame:
    rows = numbered.withColumns(
        {
            "txn_date": F.to_date("processed_timestamp"),
            "is_success": F.coalesce((F.col("gateway_status") == "SUCCESS").cast("int"), F.lit(0)),
        }
    )
    return stamp(join_date(rows, dim_date, "txn_date"), run_ts).select(*columns_of("fact_payments"), *more)


def build_fact_credit_risk(silver: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, run_ts: datetime) -> DataFrame:
    return credit_rows(assign_sk(silver, ["customer_id", "bureau_pull_date"], "credit_sk"), dim_customer, dim_date, run_ts)


def credit_rows(numbered: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, run_ts: datetime, more: Sequence[str] = ()) -> DataFrame:
    owned = lookup_sk(numbered, current(dim_customer), ["customer_id"], ["customer_sk"])
    return stamp(join_date(owned, dim_date, "bureau_pull_date"), run_ts).select(*columns_of("fact_credit_risk"), *more)

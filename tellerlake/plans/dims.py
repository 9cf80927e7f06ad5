"""Dimension builders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.functions.calendar import calendar_columns
from tellerlake.operators.joins import current, lookup_sk
from tellerlake.operators.keys import assign_sk
from tellerlake.operators.scd2 import scd2
from tellerlake.operators.skew import keyed_join
from tellerlake.schemas import warehouse_columns
from tellerlake.session import settle

# Default calendar range.
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2030, 12, 31)

# Attributes whose change opens a new version.
TRACKED = {
    "dim_branch": ["branch_name", "city", "state", "region"],
    "dim_customer": [
        "first_name", "last_name", "date_of_birth", "kyc_status", "branch_code",
        "pan_masked", "email_masked", "phone_masked",
    ],
    "dim_account": ["customer_id", "account_type", "balance", "currency", "branch_code", "status", "opened_date"],
}


def columns_of(table: str) -> list[str]:
    return [name for name, _ in warehouse_columns(table)]


def stamp(df: DataFrame, run_ts: datetime) -> DataFrame:
    return df.withColumns({"gold_load_ts": F.lit(run_ts).cast("timestamp"), "gold_layer": F.lit("gold")})


def build_dim_date(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END, fiscal_year_mode: str = "ending"
) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("d"))
    return days.select(*calendar_columns(F.col("d"), fiscal_year_mode))


def calendar_of(dates: DataFrame, column: str, fiscal_year_mode: str = "ending") -> DataFrame:
    """Calendar that covers every date of a table's column, from its smallest to its largest."""
    span = dates.agg(F.min(F.to_date(column)).alias("lo"), F.max(F.to_date(column)).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*calendar_columns(F.col("d"), fiscal_year_mode))


def calendar_span(days: Sequence[DataFrame]) -> tuple[date, date]:
    """The default calendar, widened to whole years that hold all the days of the given one-column frames."""
    every = reduce(DataFrame.unionAll, [d.select(F.to_date(d.columns[0]).alias("d")) for d in days])
    low, high = every.agg(F.min("d"), F.max("d")).first()
    start = min(CALENDAR_START, date(low.year, 1, 1)) if low else CALENDAR_START
    end = max(CALENDAR_END, date(high.year, 12, 31)) if high else CALENDAR_END
    return start, end


def branch_states(silver: DataFrame) -> DataFrame:
    """Branch rows with the time ``state_ts`` from which they hold: the source only says when a branch was
    created, so what a later load brings holds from that load on."""
    if "load_timestamp" not in silver.columns:
        return silver.withColumn("state_ts", F.col("created_at"))
    first = silver.groupBy("branch_code").agg(F.min("load_timestamp").alias("_first"))
    later = F.when(F.col("load_timestamp") > F.col("_first"), F.greatest("load_timestamp", "created_at")).otherwise(F.col("created_at"))
    return keyed_join(silver, first, ["branch_code"]).withColumn("state_ts", later).drop("_first")


def build_dim_branch(silver: DataFrame, run_ts: datetime) -> DataFrame:
    versions = settle(scd2(branch_states(silver), ["branch_code"], TRACKED["dim_branch"], "state_ts"), "versions")
    return branch_rows(assign_sk(versions, ["branch_code", "effective_from"], "branch_sk", as_type="int"), run_ts)


def branch_rows(keyed: DataFrame, run_ts: datetime) -> DataFrame:
    """Dimension rows of numbered branch versions."""
    return stamp(keyed.withColumn("source_created_at", F.col("created_at")), run_ts).select(*columns_of("dim_branch"))


def build_dim_customer(silver: DataFrame, dim_branch: DataFrame, run_ts: datetime) -> DataFrame:
    """Customer versions with the key of their current branch."""
    versions = settle(scd2(silver, ["customer_id"], TRACKED["dim_customer"], "updated_at"), "versions")
    return customer_rows(assign_sk(versions, ["customer_id", "effective_from"], "customer_sk", as_type="int"), dim_branch, run_ts)


def customer_rows(keyed: DataFrame, dim_branch: DataFrame, run_ts: datetime) -> DataFrame:
    """Dimension rows of numbered customer versions."""
    placed = lookup_sk(keyed, current(dim_branch), ["branch_code"], ["branch_sk"])
    named = placed.withColumns(
        {
            "full_name": F.concat_ws(" ", "first_name", "last_name"),
            "source_created_at": F.col("created_at"),
            "source_updated_at": F.col("updated_at"),
        }
    )
    return stamp(named, run_ts).select(*columns_of("dim_customer"))


def build_dim_account(silver: DataFrame, dim_customer: DataFrame, dim_branch: DataFrame, run_ts: datetime) -> DataFrame:
    versions = settle(scd2(silver, ["account_id"], TRACKED["dim_account"], "updated_at"), "versions")
    keyed = assign_sk(versions, ["account_id", "effective_from"], "account_sk", as_type="int")
    return account_rows(keyed, dim_customer, dim_branch, run_ts)


def account_rows(keyed: DataFrame, dim_customer: DataFrame, dim_branch: DataFrame, run_ts: datetime) -> DataFrame:
    """Dimension rows of numbered account versions."""
    owned = lookup_sk(keyed, current(dim_customer), ["customer_id"], ["customer_sk"])
    placed = lookup_sk(owned, current(dim_branch), ["branch_code"], ["branch_sk"])
    return stamp(placed.withColumn("source_created_at", F.col("created_at")), run_ts).select(*columns_of("dim_account"))

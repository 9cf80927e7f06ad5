"""Checks over tables; each returns rows (table_name, check_name, failures, rows, status)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.functions.masking import MASKS, PAN_TAIL, UNKNOWN
from tellerlake.quality.engine import HELPERS

CHECK_SCHEMA = "table_name string, check_name string, failures bigint, rows bigint, status string"


def missing(expected: list[str], actual: list[str]) -> list[str]:
    """Expected names that are not there, in their order."""
    return [e for e in expected if e not in set(actual)]


def _status(failures: Column) -> Column:
    return F.when(failures == 0, "PASS").otherwise("FAIL")


def check_rows_all(df: DataFrame, table: str, failures: dict[str, Column]) -> DataFrame:
    """Several checks over all rows in one pass; each value counts the rows that fail it."""
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(f"c{i}") for i, c in enumerate(failures.values())])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").cast("bigint").alias("failures")) for i, n in enumerate(failures)]
    )
    long = wide.select("rows", F.explode(pairs).alias("c"))
    return long.select(
        F.lit(table).alias("table_name"), "c.check_name", "c.failures", "rows", _status(F.col("c.failures")).alias("status")
    )


def _static(spark: SparkSession, table: str, check: str, failures: int) -> DataFrame:
    """A check that only needs the schema or the catalog."""
    status = "PASS" if failures == 0 else "FAIL"
    return spark.createDataFrame([(table, check, failures, None, status)], CHECK_SCHEMA)


def check_columns(df: DataFrame, table: str, expected: list[str]) -> DataFrame:
    return _static(df.sparkSession, table, "columns", len(missing(expected, df.columns)))


def check_types(df: DataFrame, table: str, expected: dict[str, str]) -> DataFrame:
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    return _static(df.sparkSession, table, "types", sum(found.get(c) != t for c, t in expected.items()))


def check_catalog(spark: SparkSession, names: list[str]) -> DataFrame:
    absent = [n for n in names if not spark.catalog.tableExists(n)]
    return _static(spark, "catalog", "tables", len(absent))


def row_range(low: int, high: int | None = None) -> Column:
    n = F.count(F.lit(1))
    bad = n < low
    return (bad if high is None else bad | (n > high)).cast("bigint")


def bad_hash() -> Column:
    return F.count_if(~F.coalesce(F.col("row_hash").rlike("^[0-9a-f]{32}$"), F.lit(False)))


def inactive() -> Column:
    return F.count_if(F.coalesce(F.col("is_active") != 1, F.lit(True)))


def any_null(cols: list[str]) -> Column:
    return F.count_if(reduce(Column.__or__, [F.col(c).isNull() for c in cols]))


def check_bronze(df: DataFrame, table: str, min_rows: int) -> DataFrame:
    return check_rows_all(
        df,
        table,
        {
            "min_rows": row_range(min_rows),
            "row_hash": bad_hash(),
            "is_active": inactive(),
            "audit_not_null": any_null(["batch_id", "src_system", "load_timestamp"]),
        },
    )


def check_silver(df: DataFrame, table: str, min_rows: int) -> DataFrame:
    """Raw personal data and helper columns are gone, and only passed rows are left."""
    leftovers = [c for c in (*MASKS, *HELPERS) if c in df.columns]
    checks = {
        "min_rows": row_range(min_rows),
        "dq_status": F.count_if(F.coalesce(F.col("dq_status") != "PASSED", F.lit(True))),
        "columns_removed": F.lit(len(leftovers)).cast("bigint"),
    }
    if "pan_masked" in df.columns:
        pan = F.col("pan_masked")
        checks["pan_masked"] = F.count_if(~pan.contains(PAN_TAIL) & (pan != UNKNOWN))
    return check_rows_all(df, table, checks)


def check_gold(df: DataFrame, table: str, pk: str, min_rows: int) -> DataFrame:
    """Key is present and not 0, and every looked-up key was found."""
    sks = [c for c in df.columns if c.endswith("_sk") and c != pk]
    checks = {"min_rows": row_range(min_rows), f"key:{pk}": F.count_if(F.coalesce(F.col(pk) == 0, F.lit(True)))}
    checks |= {f"lookup:{c}": F.count_if(F.col(c) == 0) for c in sks}
    return check_rows_all(df, table, checks)


def check_source(df: DataFrame, table: str, key: str, expected_key: str, min_rows: int) -> DataFrame:
    """Smoke check of a source: enough rows and a known key among them."""
    return check_rows_all(
        df,
        table,
        {
            "min_rows": row_range(min_rows),
            f"has:{expected_key}": (F.count_if(F.col(key) == expected_key) == 0).cast("bigint"),
        },
    )


def reconcile(
    bronze: dict[str, DataFrame], silver: dict[str, DataFrame], quarantine: dict[str, DataFrame]
) -> DataFrame:
    """Bronze rows against silver plus quarantine rows, per table and load date."""
    sides = []
    for zone, tables in (("bronze", bronze), ("silver", silver), ("quarantine", quarantine)):
        for name, df in tables.items():
            sides.append(
                df.groupBy("load_date").agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit(name).alias("table_name"), "load_date", F.lit(zone).alias("zone"), "n")
            )
    counts = reduce(DataFrame.unionAll, sides)
    wide = counts.groupBy("table_name", "load_date").agg(
        *[F.coalesce(F.sum(F.when(F.col("zone") == z, F.col("n"))), F.lit(0)).alias(f"{z}_rows") for z in ("bronze", "silver", "quarantine")]
    )
    lost = F.col("bronze_rows") - F.col("silver_rows") - F.col("quarantine_rows")
    return wide.withColumn("lost_rows", lost).withColumn("status", _status(F.col("lost_rows")))


def profile_gold(gold: dict[str, DataFrame]) -> DataFrame:
    """Calendar range, debit and credit totals and band counts as (profile, item, value) text rows."""
    dates = gold["dim_date"].agg(F.min("full_date").cast("string").alias("first"), F.max("full_date").cast("string").alias("last"))
    totals = gold["fact_transactions"].agg(
        F.sum("debit_amount").cast("string").alias("debit"), F.sum("credit_amount").cast("string").alias("credit")
    )
    bands = gold["fact_credit_risk"].groupBy("risk_band").agg(F.count(F.lit(1)).cast("string").alias("value"))

    def rows(df: DataFrame, profile: str, cols: list[str]) -> DataFrame:
        items = F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).alias("value")) for c in cols])
        return df.select(F.explode(items).alias("i")).select(F.lit(profile).alias("profile"), "i.item", "i.value")

    return (
        rows(dates, "dim_date", ["first", "last"])
        .unionAll(rows(totals, "fact_transactions", ["debit", "credit"]))
        .unionAll(bands.select(F.lit("risk_band").alias("profile"), F.col("risk_band").alias("item"), "value"))
    )


def layer_report(results: list[DataFrame]) -> DataFrame:
    """One row per table: its rows, checks run and failed, and the overall status."""
    checks = reduce(DataFrame.unionByName, results)
    broken = F.count_if(F.col("status") == "FAIL")
    return checks.groupBy("table_name").agg(
        F.max("rows").alias("rows"),
        F.count(F.lit(1)).alias("checks"),
        broken.alias("failed_checks"),
        _status(broken).alias("status"),
    )

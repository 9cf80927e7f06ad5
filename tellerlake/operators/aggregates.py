"""Small reusable aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.measures import mean2, pct


def distribution(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("count"))


def distribution_avg(df: DataFrame, c: str, measure: str) -> DataFrame:
    """Rows per value and the mean of a measure to two places."""
    sums = df.groupBy(c).agg(
        F.count(F.lit(1)).alias("count"), F.sum(measure).alias("_sum"), F.count(measure).alias("_n")
    )
    return sums.select(c, "count", mean2(F.col("_sum"), F.col("_n")).alias(f"avg_{measure}"))


def kpi(df: DataFrame, aggs: dict[str, Column]) -> DataFrame:
    return df.agg(*[a.alias(name) for name, a in aggs.items()])


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).distinct()


def value_range(df: DataFrame, c: str) -> DataFrame:
    return df.agg(F.min(c).alias("min_value"), F.max(c).alias("max_value"))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column with its NULLs, counted in one pass."""
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols])
    return wide.select("rows", F.explode(pairs).alias("p")).select("p.*", "rows")


def fk_miss(df: DataFrame, pk: str) -> DataFrame:
    """For every surrogate key column but the own one: rows at 0 and their share."""
    sks = [c for c in df.columns if c.endswith("_sk") and c != pk]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c) == 0).alias(c) for c in sks])
    pairs = F.array(*[F.struct(F.lit(c).alias("fk_column"), F.col(c).alias("missed_rows")) for c in sks])
    long = wide.select("rows", F.explode(pairs).alias("p")).select("p.*", "rows")
    return long.withColumn("missed_pct", pct(F.col("missed_rows"), F.col("rows")))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one branch of a UNION ALL each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def top_k(df: DataFrame, by: str, k: int, tie: list[str]) -> DataFrame:
    """Largest ``k`` rows with a fixed order among ties."""
    return df.orderBy(F.desc(by), *tie).limit(k)

"""Loads of gold tables into their warehouse form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tellerlake.schemas import MIN_ROWS, WAREHOUSE, warehouse_columns
from tellerlake.session import in_parallel
from tellerlake.sources.lake import Lake

LOAD_SCHEMA = "table_name string, status string, rows bigint, min_rows bigint, too_long bigint"


def conform(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Columns by name, in contract order, cast to the contract types; texts stay whole."""
    return df.select(*[F.col(name).cast("string" if kind.startswith("varchar") else kind).alias(name) for name, kind in columns])


def too_long(columns: list[tuple[str, str]]) -> Column:
    """Number of rows with a text beyond its contract length."""
    longer = [F.coalesce(F.char_length(F.col(name).cast("string")) > int(kind[8:-1]), F.lit(False)) for name, kind in columns if kind.startswith("varchar")]
    return F.count_if(reduce(Column.__or__, longer, F.lit(False)))


def load_table(lake: Lake, df: DataFrame | None, table: str, min_rows: int | None = None) -> tuple[str, str, int, int, int]:
    """Replace a warehouse table and say LOADED, LOW, FAIL or SKIP, with its rows and the rows that have a text too long.

    Texts are never cut: two keys could become one. A table with such rows fails. An empty or failed
    result is not published, so the former content stays readable. The write itself counts.
    """
    floor = MIN_ROWS[table] if min_rows is None else min_rows
    if df is None:
        return table, "SKIP", 0, floor, 0
    columns, seen = warehouse_columns(table), Observation()
    counted = conform(df, columns).observe(seen, too_long(columns).alias("too_long"))
    version, rows = lake.write_version(counted, "warehouse", table)
    if rows == 0 or seen.get["too_long"]:
        return table, "FAIL", rows, floor, seen.get["too_long"]
    lake.publish("warehouse", table, version, rows)
    return table, "LOADED" if rows >= floor else "LOW", rows, floor, 0


def load_all(lake: Lake, tables: dict[str, DataFrame], min_rows: dict[str, int] | None = None) -> DataFrame:
    """Load every warehouse table that is given; the result has one row per warehouse table."""
    floors = min_rows or MIN_ROWS
    results = in_parallel({t: lambda t=t: load_table(lake, tables.get(t), t, floors.get(t, 1)) for t in WAREHOUSE})
    return lake.spark.createDataFrame(list(results.values()), LOAD_SCHEMA)

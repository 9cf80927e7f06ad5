"""Typed columns out of all-text input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wide enough for any 64-bit id, so integers never pass through a double.
_NUMBER = "decimal(38,6)"


def parse_text(c: str) -> Column:
    return F.trim(F.col(c))


def parse_long(c: str, on_bad: str = "null") -> Column:
    """Whole part of a number; text that is no number becomes NULL (or 0 with ``on_bad='zero'``)."""
    value = F.trim(F.col(c)).try_cast(_NUMBER)
    whole = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("bigint")
    return F.coalesce(whole, F.lit(0).cast("bigint")) if on_bad == "zero" else whole


def parse_money(c: str, on_bad: str = "null") -> Column:
    value = F.trim(F.col(c)).try_cast("decimal(18,2)")
    return F.coalesce(value, F.lit(0).cast("decimal(18,2)")) if on_bad == "zero" else value


def parse_date(c: str) -> Column:
    return F.trim(F.col(c)).try_cast("date")


def parse_timestamp(c: str) -> Column:
    return F.try_to_timestamp(F.trim(F.col(c)))


def enforce_types(df: DataFrame, types: dict[str, str], on_bad: str = "null") -> DataFrame:
    """Project all-text columns to ``string``, ``bigint``, ``decimal``, ``date`` or ``timestamp``.

    Columns that are not listed pass through; listed columns missing from the input are left out.
    """
    if on_bad not in ("null", "zero"):
        raise ValueError(f"on_bad must be 'null' or 'zero', not {on_bad!r}")
    makers = {
        "string": parse_text,
        "bigint": lambda c: parse_long(c, on_bad),
        "decimal": lambda c: parse_money(c, on_bad),
        "date": parse_date,
        "timestamp": parse_timestamp,
    }
    return df.withColumns({c: makers[t](c) for c, t in types.items() if c in df.columns})


def normalize_ts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Parse text timestamps; where that fails, keep the text in ``<col>_raw``."""
    parsed = {c: parse_timestamp(c) for c in cols}
    raw = {f"{c}_raw": F.when(parsed[c].isNull(), F.col(c)) for c in cols}
    return df.withColumns(raw).withColumns(parsed)

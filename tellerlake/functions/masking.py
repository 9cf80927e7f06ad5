"""Masking of personal data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Mask texts.
UNKNOWN = "UNKNOWN"
PAN_TAIL = "*****"
EMAIL_LOCAL = "***"
PHONE_HEAD = "XXXXXX"
REDACTED = "[REDACTED]"


def mask_pan(c: str, style: str = "default") -> Column:
    col = F.col(c)
    if style == "readme":
        return F.when(col.isNull(), F.lit(UNKNOWN)).otherwise(
            F.concat(F.lit("MASKED_PAN_****"), F.right(col, F.lit(4)))
        )
    return F.coalesce(F.concat(F.substring(col, 1, 5), F.lit(PAN_TAIL)), F.lit(UNKNOWN))


def mask_email(c: str, style: str = "default") -> Column:
    if style == "readme":
        return F.regexp_replace(F.col(c), "^[^@]+", "cust_" + EMAIL_LOCAL)
    return F.regexp_replace(F.col(c), "^[^@]+", EMAIL_LOCAL)


def mask_phone(c: str, style: str = "default") -> Column:
    if style == "readme":
        return F.concat(F.lit("+91-XXXX-****"), F.right(F.col(c), F.lit(2)))
    return F.concat(F.lit(PHONE_HEAD), F.substring(F.col(c), 7, 4))


MASKS: dict[str, tuple[str, Callable[..., Column]]] = {
    "pan_number": ("pan_masked", mask_pan),
    "email": ("email_masked", mask_email),
    "phone_number": ("phone_masked", mask_phone),
}


def mask_pii(df: DataFrame, style: str = "default") -> DataFrame:
    """Add the masked columns and drop the raw ones."""
    present = [c for c in MASKS if c in df.columns]
    return df.withColumns({MASKS[c][0]: MASKS[c][1](c, style) for c in present}).drop(*present)


def mask_by_catalog(df: DataFrame, contracts: list, style: str = "default") -> DataFrame:
    """Mask every column that its contract flags as personal, in one projection.

    Columns with a mask of their own use it; other confidential columns are redacted (dates become
    the first day of their year) and internal ones keep their first letter.
    """
    out = {}
    for contract in contracts:
        c = contract.name
        if not contract.pii or c not in df.columns:
            continue
        if c in MASKS:
            out[c] = MASKS[c][1](c, style)
        elif contract.type == "date":
            out[c] = F.trunc(F.col(c), "year")
        elif contract.classification == "PII-INTERNAL":
            out[c] = F.concat(F.substring(F.trim(F.col(c)), 1, 1), F.lit(EMAIL_LOCAL))
        else:
            out[c] = F.when(F.col(c).isNotNull(), F.lit(REDACTED))
    return df.withColumns(out)


def pii_leak(df: DataFrame) -> DataFrame:
    """One row: raw columns still present, and masked PANs over all rows that show no mask."""
    leaked = [c for c in MASKS if c in df.columns]
    unmasked = F.lit(0).cast("bigint")
    if "pan_masked" in df.columns:
        pan = F.col("pan_masked")
        unmasked = F.count_if(~pan.contains(PAN_TAIL) & (pan != UNKNOWN))
    return df.agg(
        F.lit(len(leaked)).alias("raw_columns"),
        unmasked.alias("unmasked_rows"),
        F.count(F.lit(1)).alias("rows"),
    ).withColumn("clean", ((F.col("raw_columns") == 0) & (F.col("unmasked_rows") == 0)).cast("int"))

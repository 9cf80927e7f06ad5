"""Aggregate expressions used by reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean2(total: Column, n: Column) -> Column:
    """``total / n`` to two places, rounded half up in decimal arithmetic."""
    return F.round(total.cast("decimal(28,2)") / F.nullif(n, F.lit(0)).cast("decimal(18,0)"), 2)


def pct(part: Column, whole: Column, places: int = 2) -> Column:
    """Share in percent, rounded half up in decimal arithmetic, as a double."""
    ratio = part.cast("decimal(18,0)") * 100 / F.nullif(whole, F.lit(0)).cast("decimal(18,0)")
    return F.round(ratio, places).cast("double")


def failed(total: Column, ok: Column) -> Column:
    """Everything that is not a success, so pending and timed-out rows count as failed."""
    return total - ok

"""Score bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest score of a band, best band first, then the band below all of them.
RISK_BANDS = ((750, "EXCELLENT"), (650, "GOOD"), (550, "FAIR"))
RISK_BAND_ELSE = "POOR"
BANK_RISK = ((750, "LOW RISK"), (650, "MEDIUM RISK"), (550, "HIGH RISK"))
BANK_RISK_ELSE = "VERY HIGH RISK"


def band(score: Column, floors: tuple[tuple[int, str], ...], below: str) -> Column:
    """Label of the highest floor reached; lower or missing scores get ``below``."""
    label: Column = F.lit(below)
    for floor, name in reversed(floors):
        label = F.when(score >= floor, name).otherwise(label)
    return label


def risk_band(score: Column) -> Column:
    return band(score, RISK_BANDS, RISK_BAND_ELSE)


def bank_risk_category(score: Column) -> Column:
    return band(score, BANK_RISK, BANK_RISK_ELSE)

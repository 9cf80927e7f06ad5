"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the fiscal year starts in April.
FISCAL_START_MONTH = 4


def date_sk(d: Column) -> Column:
    """``yyyyMMdd`` as a number."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def fiscal_year(d: Column, mode: str = "ending") -> Column:
    """Fiscal year named by the year it ends in, or the calendar year with ``mode='calendar'``."""
    if mode == "calendar":
        return F.year(d)
    return F.year(F.add_months(d, 13 - FISCAL_START_MONTH))


def fiscal_quarter(d: Column) -> Column:
    shifted = F.add_months(d, 1 - FISCAL_START_MONTH)
    return F.concat(F.lit("Q"), F.quarter(shifted).cast("string"))


def calendar_columns(d: Column, fiscal_year_mode: str = "ending") -> list[Column]:
    """The fifteen columns of the date dimension."""
    weekday = F.weekday(d) + 1
    return [
        date_sk(d).alias("date_sk"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (weekday >= 6).cast("int").alias("is_weekend"),
        (d == F.last_day(d)).cast("int").alias("is_month_end"),
        (F.dayofmonth(d) == 1).cast("int").alias("is_month_start"),
        fiscal_year(d, fiscal_year_mode).alias("fiscal_year"),
        fiscal_quarter(d).alias("fiscal_quarter"),
    ]

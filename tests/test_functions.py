from __future__ import annotations

import hashlib
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tellerlake.functions.banding import bank_risk_category, risk_band
from tellerlake.functions.calendar import fiscal_year
from tellerlake.functions.casting import enforce_types, normalize_ts
from tellerlake.functions.hashing import row_hash
from tellerlake.functions.masking import mask_by_catalog, mask_pii, pii_leak
from tellerlake.functions.measures import failed, mean2, pct
from tellerlake.plans.dims import build_dim_date, calendar_of
from tellerlake.schemas import CATALOG


def test_types_from_text(spark):
    df = spark.createDataFrame(
        [(" Stripe ", "12.7", "1,5", "2024-02-30"), ("", "abc", "3.456", "2024-02-29"), (None, "-3.9", None, " 2024-01-01 ")],
        "name string, n string, m string, d string",
    )
    types = {"name": "string", "n": "bigint", "m": "decimal", "d": "date", "absent": "bigint"}
    got = [tuple(r) for r in enforce_types(df, types).collect()]
    assert got == [
        ("Stripe", 12, None, None),
        ("", None, Decimal("3.46"), date(2024, 2, 29)),
        (None, -3, None, date(2024, 1, 1)),
    ]
    zero = [tuple(r) for r in enforce_types(df, types, on_bad="zero").select("n", "m").collect()]
    assert zero == [(12, Decimal("0.00")), (0, Decimal("3.46")), (-3, Decimal("0.00"))]


def test_large_ids_keep_all_digits(spark):
    df = spark.createDataFrame([("9007199254740993",)], "id string")
    assert enforce_types(df, {"id": "bigint"}).first().id == 9007199254740993


def test_unknown_bad_value_mode_is_refused(spark):
    with pytest.raises(ValueError):
        enforce_types(spark.range(1), {}, on_bad="drop")


def test_timestamps_keep_unparsed_text(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("2024-01-01 10:00:00",), ("soon",), (None,)], "t string")
    got = rows(normalize_ts(df, ["t"]), "t", "t_raw")
    at = datetime(2024, 1, 1, 10)
    assert got == [(None, None), (None, "soon"), (at, None), (at, None)]


def test_hash_is_md5_of_joined_text(spark):
    df = spark.createDataFrame(
        [(1, "a", Decimal("2.50"), date(2024, 1, 1)), (1, None, Decimal("2.50"), date(2024, 1, 1))],
        "i int, s string, d decimal(18,2), t date",
    )
    first, second = [r.h for r in df.select(row_hash("i", "s", "d", "t").alias("h")).collect()]
    assert first == hashlib.md5(b"1|a|2.50|2024-01-01").hexdigest()
    assert second == hashlib.md5(b"1|None|2.50|2024-01-01").hexdigest()
    swapped = df.select(row_hash("s", "i", "d", "t").alias("h")).first().h
    assert swapped != first


def test_masks(spark):
    df = spark.createDataFrame(
        [
            ("ABCDE1234F", "jo.doe@bank.example", "9876543210"),
            ("ABC", "no-at-sign", "12345"),
            (None, None, None),
        ],
        "pan_number string, email string, phone_number string",
    )
    got = [tuple(r) for r in mask_pii(df).collect()]
    assert got == [
        ("ABCDE*****", "***@bank.example", "XXXXXX3210"),
        ("ABC*****", "***", "XXXXXX"),
        ("UNKNOWN", None, None),
    ]
    other = mask_pii(df, "readme").first()
    assert tuple(other) == ("MASKED_PAN_****234F", "cust_***@bank.example", "+91-XXXX-****10")


def test_catalog_masks_every_personal_column(spark):
    df = spark.createDataFrame(
        [(1, " Ann ", "Lee", date(1980, 5, 17), "ABCDE1234F", "a@b.example", "9876543210", "VERIFIED")],
        "customer_id int, first_name string, last_name string, date_of_birth date, pan_number string, email string, phone_number string, kyc_status string",
    )
    got = tuple(mask_by_catalog(df, CATALOG["customers"]).first())
    assert got == (1, "A***", "L***", date(1980, 1, 1), "ABCDE*****", "***@b.example", "XXXXXX3210", "VERIFIED")


def test_leak_check_looks_at_all_rows(spark):
    clean = spark.createDataFrame([("ABCDE*****",), ("UNKNOWN",)], "pan_masked string")
    assert pii_leak(clean).first().clean == 1
    leaking = clean.union(spark.createDataFrame([("ABCDE1234F",)], "pan_masked string")).withColumn("email", F.lit("x"))
    found = pii_leak(leaking).first()
    assert (found.raw_columns, found.unmasked_rows, found.rows, found.clean) == (1, 1, 3, 0)


@pytest.mark.parametrize(
    ("score", "band", "category"),
    [
        (300, "POOR", "VERY HIGH RISK"), (549, "POOR", "VERY HIGH RISK"), (550, "FAIR", "HIGH RISK"), (649, "FAIR", "HIGH RISK"),
        (650, "GOOD", "MEDIUM RISK"), (749, "GOOD", "MEDIUM RISK"), (750, "EXCELLENT", "LOW RISK"), (900, "EXCELLENT", "LOW RISK"),
        (None, "POOR", "VERY HIGH RISK"),
    ],
)
def test_bands(spark, score, band, category):
    df = spark.createDataFrame([(score,)], "s int")
    assert tuple(df.select(risk_band(F.col("s")), bank_risk_category(F.col("s"))).first()) == (band, category)


def test_measures_round_half_up(spark):
    df = spark.createDataFrame([(Decimal("0.25"), 2, 1, 3), (Decimal("1.00"), 0, 0, 0)], "total decimal(18,2), n int, ok int, all int")
    got = [tuple(r) for r in df.select(mean2(F.col("total"), F.col("n")), pct(F.col("ok"), F.col("all")), failed(F.col("all"), F.col("ok"))).collect()]
    assert got == [(Decimal("0.13"), 33.33, 2), (None, None, 0)]


def test_calendar(spark):
    dim = build_dim_date(spark)
    assert dim.count() == 4018
    assert dim.select("date_sk").distinct().count() == 4018
    by_day = {r.full_date: r for r in dim.collect()}
    leap = by_day[date(2020, 2, 29)]
    assert (leap.date_sk, leap.is_month_end, leap.day_name, leap.month_name, leap.is_weekend) == (20200229, 1, "Saturday", "February", 1)
    assert (by_day[date(2021, 1, 3)].week_of_year, by_day[date(2021, 1, 3)].day_of_week) == (53, 7)
    march, april, december = by_day[date(2025, 3, 31)], by_day[date(2025, 4, 1)], by_day[date(2025, 12, 31)]
    assert (march.fiscal_year, march.fiscal_quarter, march.is_month_end) == (2025, "Q4", 1)
    assert (april.fiscal_year, april.fiscal_quarter, april.is_month_start) == (2026, "Q1", 1)
    assert (december.fiscal_year, december.fiscal_quarter, december.quarter) == (2026, "Q3", 4)
    assert by_day[date(2025, 1, 15)].is_month_start == 0


def test_calendar_year_mode_and_span_of_data(spark):
    df = spark.createDataFrame([(date(2024, 4, 2),), (date(2024, 3, 30),), (None,)], "d date")
    assert rows(df.select(fiscal_year(F.col("d"), "calendar"))) == [(None,), (2024,), (2024,)]
    assert [str(r.full_date) for r in calendar_of(df, "d").orderBy("full_date").collect()] == ["2024-03-30", "2024-03-31", "2024-04-01", "2024-04-02"]

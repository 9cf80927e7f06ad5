from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tellerlake.plans.silver import SPEC, build_silver, quarantine_stats, reprocess
from tellerlake.quality import engine
from tellerlake.quality.rules import (
    FORMAT_RULES, RULES, Compare, Completeness, ForeignKey, InSet, Length, NoDuplicates, Uniqueness, rules_from_catalog,
)
from tellerlake.schemas import CATALOG, catalog_df

RUN = datetime(2025, 3, 1)


def broken(df, rules, parents=None):
    evaluated = engine.evaluate_rows(df, rules, parents)
    return [r.b for r in evaluated.orderBy("n").select(engine.reason_text(rules).alias("b")).collect()]


def test_only_completeness_judges_missing_values(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, "VERIFIED", "9876543210", 650), (3, "verified", "12345", 100)], "n int, kyc string, phone string, score int")
    rules = [Completeness("kyc", 0.3), InSet("kyc", ("VERIFIED",)), Length("phone", 10), Compare("score", ">=", 300)]
    assert broken(df, rules) == ["Completeness(kyc)", "", "InSet(kyc),Length(phone),Compare(score >= 300)"]
    strict = [InSet("kyc", ("VERIFIED",), null_fails=True)]
    assert broken(df, strict) == ["InSet(kyc)", "", "InSet(kyc)"]


@pytest.mark.parametrize("mode", ["plain", "tight"])
def test_uniqueness_fails_every_copy(spark, request, mode):
    if mode == "tight":
        request.getfixturevalue("tight")
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2), (4, 3), (5, 3), (6, 3), (7, None), (8, None)], "n int, k int")
    assert broken(df, [Uniqueness(("k",))]) == ["", *["Uniqueness(k)"] * 5, "", ""]
    assert broken(df, [NoDuplicates(("k", "n"))]) == [""] * 8


def test_foreign_keys(spark):
    df = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "n int, acc int")
    parent = spark.createDataFrame([(10,)], "id int")
    assert broken(df, [ForeignKey(("acc",), parent="accounts", parent_column="id")], {"accounts": parent}) == ["", "ForeignKey(acc)", ""]


def test_formats(spark):
    df = spark.createDataFrame([(1, "ABCDE1234F", "a@b.example", "9876543210"), (2, "abcde1234f", "a@b", "98765"), (3, None, None, None)], "n int, pan_number string, email string, phone_number string")
    assert broken(df, FORMAT_RULES) == ["", "Pattern(pan_number),Pattern(email),Pattern(phone_number)", ""]


def test_rule_outcomes_use_thresholds(spark):
    df = spark.createDataFrame([(i, None if i == 0 else "x") for i in range(20)], "n int, c string")
    got = rows(engine.evaluate_rules(df, [Completeness("c", 0.95), Completeness("c")], "t", "2025-03-01"), "rule_no", "ratio", "failing_rows", "failed_rows", "outcome")
    assert got == [(1, 0.95, 1, 1, "Passed"), (2, 0.95, 1, 1, "Failed")]


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "n int, c string")
    got = rows(engine.evaluate_rules(df, [Completeness("c"), Uniqueness(("n",))], "t", "2025-03-01"), "evaluated_rows", "ratio", "outcome")
    assert got == [(0, 1.0, "Passed"), (0, 1.0, "Passed")]


def test_failed_rule_names_as_array(spark):
    df = spark.createDataFrame([(1, None)], "n int, c string")
    rules = [Completeness("c"), Completeness("n")]
    assert engine.evaluate_rows(df, rules).select(engine.failed_rules(rules)).first()[0] == ["Completeness(c)"]


def test_rules_follow_from_contracts(spark):
    names = [r.name for r in rules_from_catalog(CATALOG["credit_bureau_reports"])]
    assert "Uniqueness(customer_id,bureau_pull_date)" in names
    assert "Compare(credit_score >= 300)" in names and "Compare(credit_score <= 900)" in names
    assert "InSet(risk_grade)" in names and "Completeness(risk_grade)" in names
    assert catalog_df(spark).filter("is_pii = 1").count() == 6


def test_rule_counts():
    assert {t: len(r) for t, r in RULES.items()} == {
        "branches": 4, "customers": 5, "accounts": 7, "transactions": 7, "payment_gateway_logs": 7, "credit_bureau_reports": 7,
    }


def test_gate_decisions(spark):
    counts = spark.createDataFrame([("a", 100, 0), ("b", 100, 6), ("c", 100, 5), ("d", 100, 1)], "table_name string, evaluated_rows long, failed_rows long")
    outcomes = spark.createDataFrame(
        [("a", "Completeness", "Passed"), ("b", "InSet", "Failed"), ("c", "InSet", "Failed"), ("d", "Uniqueness", "Failed")],
        "table_name string, rule_kind string, outcome string",
    )
    decisions = engine.dq_gate(counts, outcomes)
    assert rows(decisions, "table_name", "decision") == [("a", "OK"), ("b", "ALERT"), ("c", "OK"), ("d", "HALT")]
    with pytest.raises(engine.QualityHalt, match="d"):
        engine.enforce_gate(decisions)
    engine.enforce_gate(decisions.filter("table_name <> 'd'"))


CUSTOMERS = """customer_id int, first_name string, last_name string, date_of_birth date, pan_number string, email string,
    phone_number string, kyc_status string, branch_code string, created_at timestamp, updated_at timestamp, load_date date"""


def customers(spark):
    base = (" Ann ", "Lee", date(1980, 1, 1), "ABCDE1234F", "ann@bank.example")
    tail = (" BR001 ", RUN, RUN, RUN.date())
    return spark.createDataFrame(
        [(1, *base, "9876543210", "VERIFIED", *tail), (2, *base, None, "PENDING", *tail), (3, *base, "123", "VERIFIED", *tail), (4, *base, "9876543210", "verified", *tail)],
        CUSTOMERS,
    )


def test_silver_is_clean_and_quarantine_keeps_reasons_without_raw_data(spark):
    result = build_silver(customers(spark), SPEC["customers"], RUN)
    silver = result.silver.orderBy("customer_id").collect()
    assert [r.customer_id for r in silver] == [1, 2]
    assert (silver[0].first_name, silver[0].branch_code, silver[0].phone_masked, silver[1].phone_masked) == ("Ann", "BR001", "XXXXXX3210", None)
    assert not {"pan_number", "email", "phone_number", *engine.HELPERS} & set(result.silver.columns)
    assert rows(result.quarantine, "customer_id", "broken_rules", "quarantine_reason") == [(3, "Length(phone_number)", "DQ_RULE_FAILED"), (4, "InSet(kyc_status)", "DQ_RULE_FAILED")]
    assert "pan_number" not in result.quarantine.columns and "pan_masked" in result.quarantine.columns
    assert rows(quarantine_stats({"customers": result.quarantine})) == [("ALL", 2), ("customers", 2)]


def test_quarantined_rows_can_be_repaired(spark):
    raw = build_silver(customers(spark), SPEC["customers"], RUN, keep_raw=True).quarantine
    assert "phone_number" in raw.columns
    again = reprocess(raw, SPEC["customers"], lambda df: df.withColumn("kyc_status", F.upper("kyc_status")), RUN)
    assert rows(again.silver, "customer_id") == [(4,)]
    assert rows(again.quarantine, "customer_id") == [(3,)]


def test_extra_transform_hook(spark):
    from dataclasses import replace

    spec = replace(SPEC["customers"], extra_transform=lambda df: df.withColumn("vip", F.lit(1)))
    assert build_silver(customers(spark), spec, RUN).silver.first().vip == 1


def test_risk_band_in_silver(spark):
    df = spark.createDataFrame([(1, 760, "LOW", 0, Decimal("0.00"), date(2025, 1, 31)), (2, None, "LOW", 0, Decimal("0.00"), date(2025, 1, 31))], "customer_id int, credit_score int, risk_grade string, external_active_loans int, external_overdue_amount decimal(18,2), bureau_pull_date date")
    result = build_silver(df, SPEC["credit_bureau_reports"], RUN)
    assert rows(result.silver, "customer_id", "risk_band") == [(1, "EXCELLENT")]
    assert rows(result.quarantine, "customer_id", "broken_rules") == [(2, "Completeness(credit_score)")]


def test_any_number_of_rules(spark):
    df = spark.createDataFrame([(i, i) for i in range(0, 140, 7)], "n int, v int")
    rules = [Compare("v", "<=" if i % 2 else "<", i) for i in range(130)]
    wanted = [",".join(r.name for i, r in enumerate(rules) if (n > i if i % 2 else n >= i)) for n in range(0, 140, 7)]
    assert broken(df, rules) == wanted
    outcomes = engine.evaluate_rules(df, rules, "t", "2025-03-01")
    assert outcomes.count() == 130 and outcomes.filter("rule_no = 130").first().failing_rows == 1

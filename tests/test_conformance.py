"""Every registered query against its SQL counterpart, and the forced shuffle paths of the joins."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# The bank's own queries; those of the training-data package are tested beside it.
QUERIES = {name: query for name, query in entry_points.queries().items() if name in entry_points.registry.builds()}
SQL = {name: sql for name, sql in entry_points.oracle_sql().items() if name in QUERIES}
# Queries about files and checks that have no SQL form.
NO_SQL = {"checks_report", "zone_inventory"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES.split():
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def in_order(cols, data):
    by_name = sorted(cols)
    picked = [tuple(row[cols.index(c)] for c in by_name) for row in data]
    return sorted(picked, key=lambda t: tuple((v is not None, str(v)) for v in t))


def compare(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert in_order(df.columns, df.collect()) == in_order(result.columns, result.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == NO_SQL
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    compare(spark, duck, name)


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


SHUFFLED = [
    "dq_rows_transactions", "dq_foreign_keys", "dq_fk_rows_transactions", "orphan_transactions", "unique_flags_transactions",
    "fact_transactions", "fact_credit_risk", "agg_daily_balances", "vw_branch_performance", "vw_customer_risk_profile",
    "vw_daily_txn_summary", "q_star_join_top5", "scd2_customer", "scd2_customer_batch", "asof_customer_version",
    "upsert_accounts", "insert_only_transactions", "latest_transactions", "extend_surrogate_keys", "soft_delete_accounts",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_query_equals_sql_without_broadcast_and_with_hot_keys(tight, duck, name):
    compare(tight, duck, name)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 25

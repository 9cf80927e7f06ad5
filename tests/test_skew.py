"""Many hot keys, hot keys in one partition, and as-of joins that leave the facts where they are."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conformance import nights
from tellerlake import session
from tellerlake.operators.joins import asof_dim
from tellerlake.operators.skew import COPIES, broadcastable, frame_bytes, hot_keys, keyed_join, row_salt
from tests.conftest import rows


def test_thousands_of_hot_keys_are_all_spread(tight):
    many = tight.range(15_000).select((F.col("id") % 3000).alias("k"), "id")
    hot = hot_keys(many, ["k"])
    assert len(hot) == 3000
    marked = hot.mark(many, ["k"])
    assert marked.filter(f"{COPIES} IS NULL").count() == 0
    one = tight.range(2990).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = keyed_join(many, one, ["k"])
    assert joined.count() == 15_000 and joined.filter("v = 2 * k").count() == 2990 * 5


def test_fan_out_follows_the_rows_of_a_key(tight):
    many = tight.range(300).select(F.when(F.col("id") < 240, 1).otherwise(F.col("id")).cast("long").alias("k"), "id")
    assert [r[COPIES] for r in hot_keys(many, ["k"]).frame.collect()] == [80]


def test_a_key_in_one_partition_is_spread(tight):
    gathered = tight.range(1000).select(F.lit(7).alias("k"), "id").coalesce(1)
    assert gathered.select(row_salt(gathered, F.lit(8)).alias("s")).distinct().count() == 8
    again = gathered.select("id", row_salt(gathered, F.lit(8)).alias("s"))
    assert rows(again) == rows(again)


def test_nested_columns_count_by_their_size(spark):
    df = spark.range(3).select(F.sequence(F.lit(1), F.lit(1000)).alias("a"))
    assert frame_bytes(df)[1] > 3 * 3000


def versions_and_facts(spark):
    rng = random.Random(8)
    day = datetime(2024, 1, 1)
    dim = []
    for k in [1, 2, 3, None]:
        starts = sorted(rng.sample(range(200), 37 if k == 1 else 3))
        for i, s in enumerate(starts):
            end = starts[i + 1] - (1 if i % 5 == 4 else 0) if i + 1 < len(starts) else None  # some leave a gap
            dim.append((k, day + timedelta(hours=s), None if end is None else day + timedelta(hours=end), f"{k}-{s}"))
    facts = [(rng.choice([1, 1, 1, 2, 3, 4, None]), day + timedelta(minutes=rng.randrange(-600, 14_000)), i) for i in range(800)]
    facts += [(1, v[1], 10_000 + i) for i, v in enumerate(dim) if v[0] == 1] + [(1, None, 20_000)]
    d = spark.createDataFrame(dim, "k long, effective_from timestamp, effective_to timestamp, name string")
    return spark.createDataFrame(facts, "k int, ts timestamp, i int"), d, dim, facts


@pytest.mark.parametrize("limit", ["64000000", "0"])
def test_as_of_join_equals_a_scan_of_the_versions(spark, limit):
    fact, dim, versions, facts = versions_and_facts(spark)
    spark.conf.set("tellerlake.broadcast.maxBytes", limit)
    try:
        found = {r.i: r.name for r in asof_dim(fact, dim, ["k"], "ts", ["name"]).collect()}
    finally:
        spark.conf.unset("tellerlake.broadcast.maxBytes")
    for k, ts, i in facts:
        valid = [n for key, lo, hi, n in versions if ts is not None and key is not None and key == k and lo <= ts and (hi is None or ts < hi)]
        assert found[i] == (valid[-1] if valid else None)


def test_as_of_join_does_not_shuffle_the_facts(spark):
    fact, dim, _, _ = versions_and_facts(spark)
    plan = asof_dim(fact, dim, ["k"], "ts", ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize(("heap", "fits"), [(750 << 20, False), (8 << 30, True)])
def test_tables_sent_to_all_tasks_fit_the_heap_of_the_driver(spark, monkeypatch, heap, fits):
    monkeypatch.setattr(session, "driver_heap", lambda _: heap, raising=False)
    one = spark.range(1_000_000).withColumn("v", F.col("id"))  # 16 MB
    assert broadcastable(one) == fits
    plan = keyed_join(spark.range(10), one, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == fits


def test_a_set_limit_of_broadcasts_holds(spark, monkeypatch):
    monkeypatch.setattr(session, "driver_heap", lambda _: 750 << 20, raising=False)
    spark.conf.set("tellerlake.broadcast.maxBytes", "64000000")
    try:
        assert broadcastable(spark.range(1_000_000))
    finally:
        spark.conf.unset("tellerlake.broadcast.maxBytes")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_table_beyond_the_limit_is_not_broadcast_by_its_compressed_files(spark, tmp_path, how):
    spark.range(500_000).withColumn("v", F.lit(1)).write.option("compression", "zstd").parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")  # some 8 MB of rows in 2 MB of files
    spark.conf.set("tellerlake.broadcast.maxBytes", "1000000")
    try:
        plan = keyed_join(spark.range(600_000), one, ["id"], how)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("tellerlake.broadcast.maxBytes")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_names_of_the_second_night_are_looked_up_by_measured_size(tight, monkeypatch):
    large = {n: tight.range(1, 20).select(F.col("id").cast("int").alias(f"{n}_sk"), F.col("id").alias(key), F.lit("BR001").alias("branch_code"), F.lit(1).alias("is_current")) for n, key in (("account", "account_id"), ("customer", "customer_id"))}
    gold = {f"dim_{n}": df for n, df in large.items()} | {"dim_branch": tight.range(1, 3).select(F.col("id").alias("branch_sk"), F.lit("BR001").alias("branch_code"), F.lit(1).alias("is_current"))}
    gold["agg_customer_360"] = tight.range(5).select(F.col("id").cast("int").alias("customer_sk"), "id")
    fact = tight.range(9).select(F.col("id").alias("txn_id"), F.col("id").cast("int").alias("account_sk"), F.col("id").cast("int").alias("customer_sk"), F.lit(1).alias("branch_sk"))
    gold["fact_transactions"] = fact.withColumns({c: F.lit(1) for c in ("date_sk", "amount", "debit_amount", "credit_amount", "txn_date", "status")})
    measured = []
    monkeypatch.setattr(nights, "two_nights", lambda w: (None, gold, set()))
    monkeypatch.setattr(nights, "keyed_join", lambda many, one, on, **more: measured.append(on) or keyed_join(many, one, on, **more), raising=False)
    assert nights.second_run(None).filter("txn_id > 0 AND account_id = customer_id").count() == 8
    assert nights.second_customers(None).filter("home_branch IS NULL").count() == 1
    assert measured == [["account_sk"], ["customer_sk"], ["branch_sk"], ["customer_sk"]]

"""Steps of the nights write and shuffle whole rows only where they have to."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tellerlake.operators.keys import assign_sk
from tellerlake.operators.merge import new_rows, one_each
from tellerlake.operators.windows import latest
from tellerlake.plans import aggregates, continuous, incremental, maintain, silver
from tellerlake.plans.silver import SPEC, build_silver
from tellerlake.sources import parts
from tellerlake.sources.lake import Lake
from tellerlake.sources.parts import Entry, bucket, children
from tests.conftest import rows


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def settled(monkeypatch):
    """Rows that the plans write on their way, by name."""
    found: dict[str, int] = {}
    for module in (continuous, incremental, maintain, silver):
        if hasattr(module, "settle"):
            whole = module.settle

            def seen(df, name="settled", whole=whole):
                out = whole(df, name)
                found[name] = found.get(name, 0) + out.count()
                return out

            monkeypatch.setattr(module, "settle", seen)
    return found


def payments(spark, *ids, ms=5):
    shape = "txn_id bigint, gateway_name string, gateway_status string, response_code string, processing_time_ms bigint, device_type string, geo_location string, processed_timestamp timestamp"
    return spark.createDataFrame([(i, "Stripe", "SUCCESS", "00", ms, "Web", "Delhi", datetime(2024, 1, 1)) for i in ids], shape)


def test_a_load_of_one_part_is_not_shuffled(lake):
    table = lake.parts("bronze", "t")
    table.replace(lake.spark.range(0, 1000, 1, 4), "day~1", {"day~1"})
    (part, folder, n), = table.entry().folders
    assert (part, n) == ("day~1", 1000) and table.read({"day~1"}).count() == 1000
    assert len([f for f in children(lake.spark, f"{table.path}/{folder}") if f.endswith(".parquet")]) == 4  # as many as tasks had rows


@pytest.mark.parametrize("mode", ["spark", "tight"])
def test_one_each_is_latest(request, mode):
    spark = request.getfixturevalue(mode)
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "d"), (None, 3, "e"), (3, None, "f"), (3, None, "g"), (4, 0, None)], "k int, t int, v string")
    assert rows(one_each(df, ["k"], ["t"])) == rows(latest(df, ["k"], ["t"]))
    assert rows(one_each(df.limit(0), ["k"], ["t"])) == []


def test_rows_that_do_not_repeat_are_not_aggregated(spark):
    df = spark.range(100).withColumn("v", F.lit("x"))
    plan = one_each(df, ["id"], ["v"]).filter("id >= 0")
    assert plan.count() == 100
    written = incremental.merged_first(df, ["id"], ["v"])
    assert rows(written) == rows(df)


@pytest.mark.parametrize("mode", ["spark", "tight"])
@pytest.mark.parametrize("known", [range(0), range(0, 90), range(0, 10), range(0, 100)])
def test_new_rows_whichever_side_is_larger(request, mode, known):
    spark = request.getfixturevalue(mode)
    target = spark.createDataFrame([(i, 0, "old") for i in known], "k int, t int, v string")
    batch = spark.createDataFrame([(i, t, f"{i}") for i in range(100) for t in (1, 2)], "k bigint, t int, v string")
    assert rows(new_rows(target, batch, ["k"], ["t"])) == sorted(((i, 2, f"{i}") for i in range(100) if i not in known), key=lambda r: tuple((True, str(v)) for v in r))


def test_evaluated_rows_are_written_only_for_keys_beyond_a_broadcast(spark, settled):
    df = payments(spark, *range(20), 3, 4)
    few = build_silver(df, SPEC["payment_gateway_logs"], datetime(2025, 3, 1), once=True)
    assert settled == {} and few.silver.count() == 18 and few.quarantine.count() == 4
    spark.conf.set("tellerlake.broadcast.maxBytes", "0")
    try:
        many = build_silver(df, SPEC["payment_gateway_logs"], datetime(2025, 3, 1), once=True)
        assert settled == {"evaluated-payment_gateway_logs": 22}
        assert rows(many.silver) == rows(few.silver) and rows(many.quarantine) == rows(few.quarantine)
    finally:
        spark.conf.unset("tellerlake.broadcast.maxBytes")


def test_rows_known_already_are_not_written_on_the_way(lake, settled):
    spark, spec = lake.spark, maintain.FACTS["fact_payments"]
    keeper = maintain.Keeper(lake, datetime(2025, 3, 1), "month", 4)
    loads = payments(spark, *range(50)).withColumn("load_timestamp", F.lit(datetime(2025, 3, 1)))
    first = maintain.arrivals(keeper, spec, lake.parts("gold", "keys"), Entry(), loads)
    assert first.count() == 50 and settled == {}
    ledger = lake.parts("gold", "keys")
    entry = assign_sk(first, ["txn_id"], "payment_sk").select("txn_id", "payment_sk", F.lit("2024-01").alias("home"), F.col("_content").alias("digest"), F.lit(1).cast("bigint").alias("seq"))
    ledger.append(entry, bucket(["txn_id"], 4), {"buckets": 4})
    again = loads.withColumn("load_timestamp", F.lit(datetime(2025, 3, 2)))
    changed = again.withColumn("processing_time_ms", F.when(F.col("txn_id") == 7, 9).otherwise(F.col("processing_time_ms")))
    more = changed.unionByName(payments(spark, 60).withColumn("load_timestamp", F.lit(datetime(2025, 3, 2))))
    found = maintain.arrivals(keeper, spec, ledger, ledger.entry(), more)
    assert rows(found, "txn_id", "_known.home") == [(60, None), (7, "2024-01")]
    assert max(settled.values()) == 2
    # A corrected row is written again: the newest of the ledger counts.
    ledger.append(found.select("txn_id", F.lit(9).cast("bigint").alias("payment_sk"), F.lit("2024-01").alias("home"), F.col("_content").alias("digest"), F.lit(2).cast("bigint").alias("seq")), bucket(["txn_id"], 4))
    assert maintain.arrivals(keeper, spec, ledger, ledger.entry(), more).count() == 0


def test_a_load_writes_what_it_pulled_once(lake, settled):
    run = continuous.Run(lake, datetime(2025, 3, 1), "b1", [])
    assert continuous.load_source(run, "payment_gateway_logs", payments(lake.spark, *range(30)), incremental.LOOKBACK, False) == 30
    assert settled == {}
    assert incremental.read_merged(lake, "payment_gateway_logs").count() == 30


def test_numbering_deals_large_tables_over_many_tasks(spark):
    df = spark.range(0, 400_000, 1, 4).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        numbered = assign_sk(df, ["k"], "sk")
        per_task = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(per_task) == 400_000 and len(per_task) > 28 and max(per_task) < 4 * 400_000 / 32
    sample = "k % 40000 = 7"
    assert rows(numbered.filter(sample)) == rows(assign_sk(df, ["k"], "sk", digits=1).filter(sample))
    assert numbered.agg(F.min("sk"), F.max("sk"), F.countDistinct("sk")).first()[:] == (1, 400_000, 400_000)


def exchanges(df):
    df.collect()
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines() if " Exchange " in line or "- Exchange" in line]


def test_a_large_load_is_written_where_it_lies(lake, monkeypatch):
    table, part = lake.parts("silver", "t"), bucket(["id"], 2)
    df = lake.spark.range(0, 1000, 1, 4)
    assert not parts.plenty(lake.spark, 1000, 2)
    monkeypatch.setattr(parts, "FILE_ROWS", 10)
    assert parts.plenty(lake.spark, 1000, 2)
    first = table.append(df, part, placed=True)
    assert first.rows == 1000 and len(first.parts) == 2 and rows(table.read()) == rows(df)
    for _, folder, n in first.folders:
        assert n > 400 and len([f for f in children(lake.spark, f"{table.path}/{folder}") if f.endswith(".parquet")]) == 4  # one of each task


def test_cells_of_a_part_are_grouped_with_one_shuffle(spark):
    shape = "branch_sk bigint, account_sk bigint, txn_date date, volume decimal(18,2), txns bigint, largest decimal(18,2)"
    df = spark.createDataFrame([(b, a, date(2024, m, 1) if m else None, Decimal(a * m), 1, Decimal(m)) for b in (1, None) for a in (0, 1, 2, None) if a is not None for m in range(6) for _ in "ab"], shape)
    part, keys = F.coalesce(F.date_format("txn_date", "yyyy-MM"), F.lit("none")), ["branch_sk", "account_sk", "txn_date"]
    for slices in (1, 3):
        found = maintain.rolled_in_parts(df, slices, part, keys, ["volume", "txns"], ["largest"])
        assert rows(found) == rows(aggregates.roll(df, keys, ["volume", "txns"], ["largest"]))
        assert found.columns == [*keys, "volume", "txns", "largest"]
        assert len(exchanges(found)) == 1


def test_months_from_cells_equal_months_from_accounts(spark):
    shape = "branch_sk bigint, year_month string, account_sk bigint, volume decimal(18,2), credits decimal(18,2), debits decimal(18,2), txns bigint"
    cells = [(b, m, a, None if a == 3 else Decimal(a or 7), Decimal(1), None, 1) for b in (1, 2, None) for m in ("2024-01", None) for a in (1, 1, 2, 3, None)]
    cells.append((4, "2024-02", 1, None, None, None, 0))
    df = spark.createDataFrame(cells, shape)
    branches = spark.createDataFrame([(1, "B1", "one"), (4, "B4", "four")], "branch_sk bigint, branch_code string, branch_name string")
    now = datetime(2025, 3, 1)
    wanted = aggregates.monthly_rows(aggregates.roll(df, ["branch_sk", "year_month", "account_sk"], aggregates.SUMS), branches, now)
    found = aggregates.monthly_cells(df, branches, now)
    assert rows(found) == rows(wanted) and found.schema == wanted.schema


def test_a_ledger_of_texts_goes_on_as_texts(lake):
    spark, spec = lake.spark, maintain.FACTS["fact_payments"]
    keeper = maintain.Keeper(lake, datetime(2025, 3, 1), "month", 4)
    loads = payments(spark, *range(9)).withColumn("load_timestamp", F.lit(datetime(2025, 3, 1)))
    first = maintain.arrivals(keeper, spec, lake.parts("gold", "keys"), Entry(), loads)
    assert first.schema["_content"].dataType.typeName() == "binary"
    ledger = lake.parts("gold", "keys")
    shown = first.select("txn_id", F.col("txn_id").alias("payment_sk"), F.lit("2024-01").alias("home"), F.lower(F.hex("_content")).alias("digest"), F.lit(1).cast("bigint").alias("seq"))
    ledger.append(shown, bucket(["txn_id"], 4), {"buckets": 4})
    assert maintain.arrivals(keeper, spec, ledger, ledger.entry(), loads).count() == 0
    changed = maintain.arrivals(keeper, spec, ledger, ledger.entry(), payments(spark, 3, ms=6).withColumn("load_timestamp", F.lit(datetime(2025, 3, 2))))
    assert rows(changed, "txn_id", "_known.payment_sk") == [(3, 3)] and changed.schema["_content"].dataType.typeName() == "string"

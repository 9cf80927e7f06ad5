"""Nights that extend gold against a full rebuild; part tables; untouched parts are not read."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conformance import mapping
from tellerlake.operators.scd2 import number_versions
from tellerlake.plans import maintain, nightly
from tellerlake.plans.continuous import run_incremental_night
from tellerlake.plans.incremental import incremental_run, read_merged
from tellerlake.plans.nightly import RunStopped, run_nightly
from tellerlake.sources.lake import Lake
from tellerlake.sources.parts import VersionTaken, bucket, part_name
from tellerlake.sources.state import high_water, read_run_log
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
CALENDAR = (date(1995, 1, 1), date(2030, 12, 31))


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


# --- tables of parts ----------------------------------------------------------------------------


def table_rows(spark, *data):
    return spark.createDataFrame(data, "id int, day string, v string")


def test_a_load_owns_its_part_even_without_rows(lake):
    spark, table = lake.spark, lake.parts("silver", "t")
    table.replace(table_rows(spark, (1, "a", "x"), (2, "b", "x"), (3, None, "x")), part_name("day"))
    entry = table.replace(table_rows(spark, (1, "a", "y")).limit(0), part_name("day"), {"a"})
    assert rows(lake.read("silver", "t"), "id") == [(2,), (3,)]
    assert entry.parts == {"b", "none"} and entry.rows == 2
    table.replace(table_rows(spark, (9, "b", "z")), part_name("day"))
    table.append(table_rows(spark, (8, "b", "z")).withColumn("more", F.lit(1)), part_name("day"), {"top": 9})
    assert rows(table.read({"b"}), "id", "more") == [(8, 1), (9, None)]
    assert table.entry().notes == {"top": 9}
    assert rows(table.read(entry=table.entry(2)), "id") == [(2,), (3,)]


def test_a_table_without_any_row_can_be_read(lake):
    table = lake.parts("silver", "t")
    table.replace(table_rows(lake.spark, (1, "a", "x")).limit(0), part_name("day"))
    assert lake.read("silver", "t").columns == ["id", "day", "v"] and lake.read("silver", "t").count() == 0
    with pytest.raises(LookupError):
        lake.parts("silver", "nothing").read()


def test_vacuum_keeps_what_listed_versions_need(lake):
    spark, table = lake.spark, lake.parts("silver", "t")
    for n in range(4):
        table.replace(table_rows(spark, (n, "a", "x"), (n, f"d{n}", "x~/%: é")), part_name("day"))
    before = rows(table.read())
    assert table.vacuum(keep=2) == 2  # part a of the first two versions
    assert rows(table.read()) == before and len(table.published()) == 2
    assert rows(table.read(entry=table.entry(3)), "id") == [(0,), (1,), (2,), (2,)]
    assert table.vacuum(keep=2) == 0


def test_a_version_is_published_once_and_a_broken_one_is_none(lake, monkeypatch):
    spark, table = lake.spark, lake.parts("silver", "t")
    table.replace(table_rows(spark, (1, "a", "x")), part_name("day"))
    entries = Path(table.path) / "entries"
    (entries / "v0000000002.json.123.draft").write_text("{")  # a writer died before its entry was complete
    assert table.entry().version == 1
    table.replace(table_rows(spark, (2, "a", "x")), part_name("day"))
    assert rows(table.read(), "id") == [(2,)]
    stale = table.entry(1)
    with pytest.raises(VersionTaken):
        table._publish(stale, stale.folders, stale.schema, None)


def test_a_merge_of_one_row_writes_one_bucket(lake):
    source = mapping.source(lake.spark, SF, "customers")
    incremental_run(lake, "customers", source, "b1", datetime(2025, 3, 1))
    table = lake.parts("silver", "customers_merged")
    before = table.entry()
    one = mapping.moved_customers(lake.spark, SF).filter("customer_id = 11")
    incremental_run(lake, "customers", one, "b2", datetime(2025, 3, 2))
    after = table.entry()
    assert len(set(after.folders) - set(before.folders)) == 1 and len(set(after.folders) & set(before.folders)) == 15
    assert read_merged(lake, "customers").filter("customer_id = 11").first().updated_at == datetime(2024, 4, 1)


def test_vacuum_of_whole_versions(lake):
    for n in range(3):
        lake.replace(lake.spark.range(n + 1), "gold", "t")
    lake.write_version(lake.spark.range(9), "gold", "t")  # never published
    assert lake.vacuum("gold", "t", keep=1) == 3
    assert lake.current("gold", "t").count() == 3 and lake.vacuum("gold", "t", keep=1) == 0


# --- marks --------------------------------------------------------------------------------------


def transactions(spark, *data):
    shape = "txn_id bigint, account_id bigint, txn_type string, amount decimal(18,2), txn_timestamp timestamp, channel string, status string"
    return spark.createDataFrame([(i, 100001, "Debit", None, t, "UPI", s) for i, t, s in data], shape).withColumn("amount", F.lit(5).cast("decimal(18,2)"))


def test_rows_from_the_future_do_not_move_the_mark(lake):
    spark, ahead = lake.spark, datetime(2999, 1, 1)
    first = transactions(spark, (1, datetime(2024, 1, 1), "SUCCESS"), (2, ahead, "NONSENSE"), (3, ahead, "SUCCESS"))
    assert incremental_run(lake, "transactions", first, "b1", datetime(2024, 1, 2)) == 2
    assert high_water(lake, "transactions") == datetime(2024, 1, 1)
    second = transactions(spark, *[(i, datetime(2024, 1, 2), "SUCCESS") for i in range(10, 25)])
    assert incremental_run(lake, "transactions", first.union(second), "b2", datetime(2024, 1, 3)) == 15
    assert read_merged(lake, "transactions").count() == 17


def test_rows_of_the_window_are_known_by_their_content(lake):
    spark = lake.spark
    day = datetime(2024, 1, 5)
    first = transactions(spark, (1, day, "SUCCESS"), (2, day - timedelta(days=3), "SUCCESS"))
    look = timedelta(days=10)
    incremental_run(lake, "transactions", first, "b1", datetime(2024, 1, 6), look)
    more = first.union(transactions(spark, (3, day - timedelta(days=9), "SUCCESS")))
    assert incremental_run(lake, "transactions", more, "b2", datetime(2024, 1, 7), look) == 1
    state = lake.read_log("watermarks", "last_batch_id string, rows_last_loaded bigint")
    assert rows(state, "last_batch_id", "rows_last_loaded") == [("b1", 2), ("b2", 1)]


# --- loads of a date ----------------------------------------------------------------------------


def test_a_repeated_date_leaves_nothing_stale(lake):
    spark = lake.spark
    good = mapping.source(spark, SF, "accounts").filter("balance >= 0").limit(40)
    bad = good.limit(20).withColumn("balance", F.lit(-1).cast("decimal(18,2)"))
    run = nightly.Run(lake, datetime(2025, 3, 1), "r1", [])
    nightly.ingest(run, "accounts", bad)
    assert nightly.refine(run, "accounts", halt=False) == 0  # a load of which no row passes
    assert lake.read("quarantine", "accounts").count() == 20 and lake.read("silver", "accounts").count() == 0
    again = nightly.Run(lake, datetime(2025, 3, 1), "r2", [])
    assert nightly.ingest(again, "accounts", good) == 40
    assert nightly.refine(again, "accounts", halt=False) == 40
    assert {z: lake.read(z, "accounts").count() for z in ("bronze", "silver", "quarantine")} == {"bronze": 40, "silver": 40, "quarantine": 0}


# --- nights -------------------------------------------------------------------------------------

LATE = "txn_id % 10 = 3 AND txn_timestamp >= timestamp '2000-09-01'"
FIXED = "txn_id % 5 = 2 AND txn_timestamp >= timestamp '2000-06-01' AND txn_timestamp < timestamp '2000-08-01'"
LOOK = timedelta(days=500)


def first_state(spark):
    state = {t: mapping.source(spark, SF, t) for t in mapping.TABLES}
    state["transactions"] = state["transactions"].dropDuplicates(["txn_id"])
    return state


def corrected(state):
    """Late rows, corrected amounts, and corrected days."""
    fixed = F.expr(FIXED)
    return state | {"transactions": state["transactions"].withColumns({
        "amount": F.when(fixed, (F.col("amount") / 2).cast("decimal(18,2)")).otherwise(F.col("amount")),
        "txn_timestamp": F.when(fixed & (F.col("txn_id") % 2 == 0), F.col("txn_timestamp") + F.expr("interval 65 days")).otherwise(F.col("txn_timestamp")),
    })}


def second_state(spark):
    """Corrected transactions, moved customers, moved accounts, a renamed branch."""
    state = corrected(first_state(spark))
    moved = mapping.moved_customers(spark, SF)
    state["customers"] = state["customers"].filter("customer_id % 10 <> 1").unionByName(moved)
    newer = F.col("account_id").isin(100005, 100009, 100020)
    state["accounts"] = state["accounts"].withColumns({
        "branch_code": F.when(newer, F.lit("BR002")).otherwise(F.col("branch_code")),
        "updated_at": F.when(newer | F.col("account_id").isin(*UNKNOWN), F.lit(datetime(2024, 5, 1))).otherwise(F.col("updated_at")),
    })
    state["branches"] = state["branches"].withColumn("branch_name", F.when(F.col("branch_code") == "BR004", F.lit("Renamed")).otherwise(F.col("branch_name")))
    return state


# Accounts that come later than their transactions.
UNKNOWN = (100004, 100007)


def night(lake, state, day):
    return run_incremental_night(lake, state, day, CALENDAR, False, LOOK, "month", 4)


STAMPS = ["gold_load_ts", "gold_layer", "agg_type"]
NAMED = {"account_sk": ("dim_account", "account_id"), "customer_sk": ("dim_customer", "customer_id"), "branch_sk": ("dim_branch", "branch_code")}


def natural(gold, name):
    """A gold table with natural keys in place of numbers."""
    df = gold[name].drop(*STAMPS, "txn_sk", "payment_sk", "credit_sk")
    for sk, (dim, key) in NAMED.items():
        if sk in df.columns:
            parents = gold[dim].filter("is_current = 1").select(sk, F.col(key).alias(f"of_{key}"))
            df = df.join(parents, sk, "left").drop(sk)
    return rows(df, *sorted(df.columns))


class Nights:
    """Four nights of one lake: the first load; corrections, broken off in the middle; changed dimensions; the same again."""

    def __init__(self, lake):
        self.lake, spark = lake, lake.spark
        state = first_state(spark)
        early = state | {"transactions": state["transactions"].filter(f"NOT ({LATE})"), "accounts": state["accounts"].filter(~F.col("account_id").isin(*UNKNOWN))}
        one = night(lake, early, "2025-03-01")
        self.keys = {d: rows(one[d].filter("is_current = 1"), sk, key) for sk, (d, key) in NAMED.items()}
        self.numbers = rows(one["fact_transactions"], "txn_id", "txn_sk")
        fact = lake.parts("gold", "fact_transactions")
        before = fact.entry()
        self.hidden = [f for p, f, _ in before.folders if p < "2000-06"]
        files = [f for folder in self.hidden for f in (Path(fact.path) / folder).glob("*.parquet")]
        contents = {f: f.read_bytes() for f in files}
        for f in files:  # reading any of these fails
            f.write_bytes(b"unreadable")
            (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
        with pytest.MonkeyPatch.context() as broken:
            broken.setattr(maintain, "keep_days", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RunStopped, match="lost"):
                night(lake, corrected(state) | {"accounts": early["accounts"]}, "2025-03-02")
        self.second = fact.entry()
        for f in files:
            f.write_bytes(contents[f])
        self.gold = night(lake, second_state(spark), "2025-03-03")
        kept = ("fact_transactions", "daily_cube", "account_totals", "agg_customer_360", "customer_days", "agg_monthly_summary", "agg_daily_balances")
        self.third = {t: lake.parts("gold", t).entry().folders for t in kept}
        night(lake, second_state(spark), "2025-03-04")
        self.fourth = {t: lake.parts("gold", t).entry().folders for t in kept}


@pytest.fixture(scope="module")
def nights(spark, tmp_path_factory):
    return Nights(Lake(spark, str(tmp_path_factory.mktemp("nights") / "lake")))


TABLES = ["fact_transactions", "fact_payments", "fact_credit_risk", "agg_daily_balances", "agg_monthly_summary", "agg_branch_performance", "agg_customer_360"]


@pytest.fixture(scope="module")
def rebuilt(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("rebuilt") / "lake"))
    state = second_state(spark)
    return run_nightly(lake, state, "2025-03-02", CALENDAR, halt_on_critical=False)


@pytest.mark.parametrize("name", TABLES)
def test_nights_equal_a_full_rebuild(nights, rebuilt, name):
    """Although the second night broke off between the aggregates."""
    assert natural(nights.gold, name) == natural(rebuilt, name)


def test_numbers_of_the_first_night_stay(nights):
    gold = nights.gold
    for sk, (dim, key) in NAMED.items():
        assert set(nights.keys[dim]) <= set(rows(gold[dim].filter("is_current = 1"), sk, key))
        assert gold[dim].select(sk).distinct().count() == gold[dim].count()
    fact = gold["fact_transactions"]
    assert set(nights.numbers) <= set(rows(fact, "txn_id", "txn_sk"))
    assert fact.select("txn_sk").distinct().count() == fact.count()
    history = gold["dim_customer"].filter("customer_id = 11").orderBy("effective_from").collect()
    assert [(h.is_current, h.effective_to) for h in history] == [(0, datetime(2024, 4, 1)), (1, None)]
    assert gold["dim_branch"].filter("branch_code = 'BR004'").count() == 2


def test_a_night_repeated_writes_no_fact_and_no_aggregate(nights):
    assert nights.fourth == nights.third


def test_parts_that_nothing_touches_are_not_read(nights):
    """The second night ran while they were unreadable."""
    assert len(nights.hidden) > 50 and set(nights.hidden) <= {f for _, f, _ in nights.second.folders}
    assert nights.second.rows == len(nights.numbers) + nights.lake.spark.createDataFrame(nights.numbers, "i long, sk long").join(
        nights.gold["fact_transactions"], F.col("i") == F.col("txn_id"), "right").filter("i IS NULL").count()


def test_the_broken_night_is_logged(nights):
    failed = read_run_log(nights.lake).filter("status = 'FAILED'").collect()
    assert [(f.step, f.error) for f in failed] == [("extend", "RuntimeError: lost")]


def test_no_raw_personal_data_under_silver_and_gold(nights):
    lake = nights.lake
    for df in (lake.read("silver", "customers"), lake.read("silver", "customers_merged"), nights.gold["dim_customer"], lake.read("quarantine", "customers")):
        assert not {"pan_number", "email", "phone_number"} & set(df.columns)


def test_open_versions_hand_their_number_on(spark):
    def versions(*data):
        return spark.createDataFrame(data, "key string, effective_from timestamp, effective_to timestamp, is_current int")

    t = [datetime(2024, 1, d) for d in (1, 2, 3)]
    first = number_versions(versions(("a", t[0], t[1], 0), ("a", t[1], None, 1), ("b", t[0], None, 1)), None, ["key"], "sk")
    assert sorted(r.sk for r in first.filter("is_current = 1").collect()) == [1, 2] and first.filter("is_current = 0").first().sk == 3
    number = first.filter("key = 'a' AND is_current = 1").first().sk
    second = number_versions(versions(("a", t[0], t[1], 0), ("a", t[1], t[2], 0), ("a", t[2], None, 1)), first.filter("key = 'a'"), ["key"], "sk", 3)
    assert rows(second, "effective_from", "sk") == [(t[0], 3), (t[1], 4), (t[2], number)]


def test_buckets_depend_on_the_value_only(spark):
    as_int, as_long = spark.range(50).select(F.col("id").cast("int").alias("k")), spark.range(50).select(F.col("id").alias("k"))
    assert rows(as_int.select(bucket(["k"], 7).alias("b"))) == rows(as_long.select(bucket(["k"], 7).alias("b")))

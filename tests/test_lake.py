from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from conformance import mapping
from tellerlake.functions.casting import enforce_types
from tellerlake.plans import checks, views
from tellerlake.plans.dims import build_dim_branch
from tellerlake.plans.incremental import incremental_run, read_merged
from tellerlake.plans.nightly import RunStopped, parse_run_date, run_nightly
from tellerlake.quality.engine import OUTCOME_SCHEMA
from tellerlake.schemas import WAREHOUSE, landing_types, warehouse_columns
from tellerlake.session import settle, shared_dir
from tellerlake.sources.lake import (
    EmptySource, Lake, RowCountMismatch, register_external, register_zone, require_rows, write_verified, zone_inventory,
)
from tellerlake.sources.landing import AUDIT, AUDIT_RELATIONAL, Batch, RelationalTable, add_audit_columns, jdbc_options, read_landing_csv, read_relational
from tellerlake.sources.state import EPOCH, append_run_log, high_water, incremental, read_run_log, read_watermarks, run_status, update_watermark
from tellerlake.sources.warehouse import conform, load_table, too_long

SF = "/root/testdata/sf0.001"
RUN = datetime(2025, 3, 1)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_shared_folder_comes_from_the_cluster(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = settle(spark.range(3))
    assert df.inputFiles()[0].startswith(f"file://{shared_dir(spark)}")


def test_landing_csv_is_text(spark, tmp_path):
    (tmp_path / "payment_gateway_logs_1.csv").write_text('txn_id,gateway_name,note\n1, Stripe ,"a, quoted"\nabc,,x\n')
    (tmp_path / "other.csv").write_text("txn_id,gateway_name,note\n9,Z,z\n")
    df = read_landing_csv(spark, str(tmp_path), ["txn_id", "gateway_name", "note"], "payment_gateway_logs_*.csv")
    assert rows(df) == [("1", " Stripe ", "a, quoted", "payment_gateway_logs_1.csv"), ("abc", None, "x", "payment_gateway_logs_1.csv")]
    assert rows(enforce_types(df, {"txn_id": "bigint"}), "txn_id") == [(None,), (1,)]


def test_landing_csv_with_wrong_header_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("other,gateway_name\n1,Stripe\n")
    with pytest.raises(Exception, match="header"):
        read_landing_csv(spark, str(tmp_path), ["txn_id", "gateway_name"]).collect()


def test_audit_columns(spark):
    df = spark.createDataFrame([(1, "a", "f.csv")], "id int, v string, src_file_name string")
    csv = add_audit_columns(df, Batch("b1", RUN, "gateway_csv"))
    assert csv.columns == ["id", "v", *AUDIT]
    row = csv.first()
    assert (row.src_file_name, row.load_date, row.is_active, row.batch_id) == ("f.csv", RUN.date(), 1, "b1")
    relational = add_audit_columns(df.drop("src_file_name"), Batch("b1", RUN, "core", "accounts", "FULL"))
    assert relational.columns == ["id", "v", *AUDIT_RELATIONAL]
    assert relational.first().row_hash == row.row_hash


def test_relational_source(spark, tmp_path):
    spark.range(3).selectExpr("id", "id * 2 AS twice", "'x' AS other").write.parquet(str(tmp_path / "t"))
    table = RelationalTable("bank.t", ("id", "twice"), "id", path=str(tmp_path / "t"))
    assert rows(read_relational(spark, table)) == [(0, 0), (1, 2), (2, 4)]
    remote = RelationalTable("bank.t", ("id",), "id", url="jdbc:x://db.example", lower=1, upper=100, partitions=4)
    options = jdbc_options(remote)
    assert options["dbtable"] == "(SELECT id FROM bank.t) src" and options["numPartitions"] == "4"
    assert jdbc_options(RelationalTable("bank.t", ("id",), "id", url="jdbc:x://db.example"))["query"] == "SELECT id FROM bank.t"
    with pytest.raises(ValueError):
        jdbc_options(RelationalTable("bank.t", ("id",), "id"))


def test_partitions_are_replaced_one_by_one(lake):
    day = lambda d, v: lake.spark.createDataFrame([(v, date(2025, 3, d))], "v int, load_date date")
    lake.overwrite(day(1, 1).union(day(2, 2)), "silver", "t", ["load_date"])
    lake.overwrite(day(2, 5), "silver", "t", ["load_date"])
    assert rows(lake.read("silver", "t"), "v") == [(1,), (5,)]
    with pytest.raises(ValueError):
        lake.path("nowhere", "t")


def test_versions_are_published_whole(lake):
    spark = lake.spark
    with pytest.raises(LookupError):
        lake.current("gold", "t")
    lake.replace(spark.range(3), "gold", "t")
    lake.write_version(spark.range(9), "gold", "t")
    assert lake.current("gold", "t").count() == 3
    # A table may be computed from its own former version.
    lake.replace(lake.current("gold", "t").filter("id > 0"), "gold", "t")
    assert rows(lake.current("gold", "t")) == [(1,), (2,)]
    assert lake.versions().count() == 2


def test_write_is_verified(spark, tmp_path, monkeypatch):
    assert write_verified(spark.range(7), str(tmp_path / "ok")) == 7
    spark.range(2).write.parquet(str(tmp_path / "more"))
    with pytest.raises(RowCountMismatch):
        write_verified(spark.range(7), str(tmp_path / "more"), mode="append")


def test_empty_sources_are_refused(spark):
    with pytest.raises(EmptySource):
        require_rows(spark.range(0), "t")
    assert (require_rows(spark.range(5), "t", 5), require_rows(spark.range(5), "t", 6)) == ("OK", "LOW")


def test_inventory_and_registration(lake):
    spark = lake.spark
    lake.append(spark.range(5), "bronze", "a")
    lake.replace(spark.range(4), "gold", "b")
    found = {(r.zone, r.table_name): (r.files, r.bytes) for r in zone_inventory(spark, lake.base).collect()}
    assert set(found) == {("bronze", "a"), ("gold", "b"), ("metadata", "versions")}
    assert all(f > 0 and b > 0 for f, b in found.values())
    assert register_zone(lake, "gold", ["b", "absent"], "v_") == ["v_b"]
    assert spark.table("v_b").count() == 4
    assert register_external(lake, "gold", ["b"], "x_") == ["x_b"]
    lake.replace(spark.range(2), "gold", "b")
    register_external(lake, "gold", ["b"], "x_")
    assert spark.table("x_b").count() == 2
    assert rows(checks.check_catalog(spark, ["x_b", "x_none"]), "failures", "status") == [(1, "FAIL")]


# --- state -----------------------------------------------------------------------------------


def test_watermarks_keep_configuration_and_never_move_back(lake):
    spark = lake.spark
    assert high_water(lake, "customers") == EPOCH
    loaded = spark.createDataFrame([(1, datetime(2024, 5, 1)), (2, datetime(2024, 6, 1))], "customer_id int, updated_at timestamp")
    update_watermark(lake, "customers", loaded, "b1", RUN)
    update_watermark(lake, "customers", loaded.limit(0), "b2", RUN + timedelta(days=1))
    state = read_watermarks(lake).filter("source = 'customers'").first()
    assert (state.high_water, state.load_type, state.watermark_column) == (datetime(2024, 6, 1), "INCREMENTAL_MERGE", "updated_at")
    assert (state.rows_last_loaded, state.last_batch_id) == (0, "b2")
    assert read_watermarks(lake).count() == 6
    pulled = incremental(loaded, "updated_at", datetime(2024, 5, 1))
    # Rows at the time of the mark and rows without a time are read again, earlier ones only by looking back.
    assert rows(pulled, "customer_id") == [(1,), (2,)]
    assert rows(incremental(loaded, "updated_at", datetime(2024, 5, 2)), "customer_id") == [(2,)]
    assert incremental(loaded, "updated_at", datetime(2024, 5, 2), timedelta(days=1)).count() == 2
    timeless = loaded.unionByName(spark.createDataFrame([(3, None)], loaded.schema))
    assert rows(incremental(timeless, "updated_at", datetime(2025, 5, 2)), "customer_id") == [(3,)]
    assert incremental(loaded, None, datetime(2030, 1, 1)).count() == 2


def test_incremental_loads_by_policy(lake):
    spark = lake.spark
    t = lambda d: datetime(2024, 1, d)
    shape = "txn_id int, account_id int, txn_type string, amount decimal(18,2), txn_timestamp timestamp, channel string, status string"

    def transactions(*data):
        return spark.createDataFrame([(i, 1, "Debit", Decimal(a), d, "UPI", "SUCCESS") for i, a, d in data], shape)

    txns = transactions((1, 5, t(1)), (2, 5, t(2)), (2, 5, t(2)), (9, -1, t(2)))
    assert incremental_run(lake, "transactions", txns, "b1", RUN) == 2
    # A new row, one at the time of the mark, one that comes late, one without a time.
    more = txns.union(transactions((3, 5, t(3)), (4, 5, t(2)), (5, 5, datetime(2024, 1, 1, 6)), (6, 5, None)))
    assert incremental_run(lake, "transactions", more, "b2", RUN + timedelta(days=1)) == 3
    assert incremental_run(lake, "transactions", more, "b3", RUN + timedelta(days=2)) == 0
    assert rows(read_merged(lake, "transactions"), "txn_id") == [(1,), (2,), (3,), (4,), (5,)]
    failed = lake.read("quarantine", "transactions_merged")
    assert rows(failed.filter("batch_id = 'b2'"), "txn_id", "broken_rules") == [(6, "Completeness(txn_timestamp)"), (9, "Compare(amount > 0)")]

    shape = "branch_code string, branch_name string, city string, state string, region string, created_at timestamp"
    branches = spark.createDataFrame([("A", "a", "old", "s", "r", t(1)), ("B", "b", "x", "s", "r", t(1)), ("D", "d", "z", "s", "r", t(1))], shape)
    incremental_run(lake, "branches", branches, "b1", RUN)
    second = spark.createDataFrame([("A", "a", "new", "s", "r", t(1)), ("C", "c", "y", "s", "r", t(1)), ("D", "d", None, "s", "r", t(1))], shape)
    incremental_run(lake, "branches", second, "b2", RUN + timedelta(days=1))
    assert rows(read_merged(lake, "branches"), "branch_code", "city", "is_active") == [("A", "new", 1), ("B", "x", 0), ("C", "y", 1), ("D", "z", 1)]


def test_incremental_loads_hold_no_raw_personal_data(lake):
    spark = lake.spark
    incremental_run(lake, "customers", mapping.source(spark, SF, "customers"), "b1", RUN)
    incremental_run(lake, "customers", mapping.moved_customers(spark, SF), "b2", RUN + timedelta(days=1))
    merged, failed = read_merged(lake, "customers"), lake.read("quarantine", "customers_merged")
    assert merged.count() > 0 and failed.count() > 0
    for df in (merged, failed):
        assert not {"pan_number", "email", "phone_number"} & set(df.columns) and "pan_masked" in df.columns


def test_files_with_older_rows_arrive(lake):
    logs = mapping.source(lake.spark, SF, "payment_gateway_logs").filter("processing_time_ms >= 0")
    middle = logs.approxQuantile("txn_id", [0.5], 0.0)[0]
    first, second = logs.filter(F.col("txn_id") > middle), logs.filter(F.col("txn_id") <= middle)
    one = incremental_run(lake, "payment_gateway_logs", first, "b1", RUN)
    two = incremental_run(lake, "payment_gateway_logs", second, "b2", RUN + timedelta(days=1))
    failed = lake.read("quarantine", "payment_gateway_logs_merged").count()
    assert one + two + failed == logs.select("txn_id").distinct().count()


def test_run_log(lake):
    append_run_log(lake, [("b1", RUN, "bronze", "a", "SUCCESS", 5, 1.5), ("b1", RUN, "bronze", "b", "FAILED", 0, 0.5), ("b2", RUN, "gold", "c", "SUCCESS", 7, 1.0)])
    append_run_log(lake, [("b3", RUN, "gold", "c", "FAILED", 0, 1.0)])
    assert rows(run_status(read_run_log(lake)), "batch_id", "status", "steps", "total_rows", "duration_s") == [
        ("b1", "PARTIAL", 2, 5, 2.0), ("b2", "SUCCESS", 1, 7, 1.0), ("b3", "FAILED", 1, 0, 1.0),
    ]


# --- warehouse -------------------------------------------------------------------------------


def test_conform_casts_and_keeps_texts_whole(spark):
    df = spark.createDataFrame([("toolong", 7, Decimal("1.5"), "drop"), ("fits", 8, None, "x"), (None, 9, None, "x")], "b string, a long, m decimal(10,1), extra string")
    columns = [("a", "int"), ("b", "varchar(4)"), ("m", "decimal(18,2)")]
    out = conform(df, columns)
    assert out.dtypes == [("a", "int"), ("b", "string"), ("m", "decimal(18,2)")]
    assert tuple(out.first()) == (7, "toolong", Decimal("1.50"))
    assert out.agg(too_long(columns)).first()[0] == 1


def test_texts_beyond_the_contract_fail_the_load(lake):
    codes = lake.spark.createDataFrame([("BR0000000001",), ("BR0000000002",)], "branch_code string")
    branches = codes.select(*[F.col(n) if n == "branch_code" else F.lit(None).cast("string" if k.startswith("varchar") else k).alias(n) for n, k in warehouse_columns("dim_branch")])
    assert load_table(lake, branches, "dim_branch", 1) == ("dim_branch", "FAIL", 2, 1, 2)
    assert lake.current_path("warehouse", "dim_branch") is None


def test_warehouse_definitions_parse():
    assert {t: len(warehouse_columns(t)) for t in WAREHOUSE} == {
        "dim_date": 15, "dim_branch": 12, "dim_customer": 19, "dim_account": 16, "fact_transactions": 16, "fact_payments": 14,
        "fact_credit_risk": 12, "agg_daily_balances": 10, "agg_monthly_summary": 12, "agg_branch_performance": 15, "agg_customer_360": 13,
    }


def test_an_empty_load_keeps_the_former_content(lake):
    spark = lake.spark
    dates = spark.createDataFrame([(1, "2024-01-01")], "date_sk int, full_date string")
    for name, kind in warehouse_columns("dim_date")[2:]:
        dates = dates.withColumn(name, F.lit(None).cast("string" if kind.startswith("varchar") else kind))
    assert load_table(lake, dates, "dim_date", 1) == ("dim_date", "LOADED", 1, 1, 0)
    assert load_table(lake, dates, "dim_date")[1] == "LOW"
    assert load_table(lake, dates.limit(0), "dim_date")[1] == "FAIL"
    assert load_table(lake, None, "dim_date")[1] == "SKIP"
    assert lake.current("warehouse", "dim_date").count() == 1


# --- the nightly run -------------------------------------------------------------------------


@pytest.mark.parametrize(("text", "expected"), [("2026-04-19", date(2026, 4, 19)), ("2026-04-19T02:00:00Z", date(2026, 4, 19)), ("2026-04-19T02:00:00.5+05:30", date(2026, 4, 19))])
def test_run_dates(text, expected):
    assert parse_run_date(text) == expected


@pytest.mark.parametrize("text", ["<aws.scheduler.scheduled-time>", "", "19.04.2026", "2026-13-45"])
def test_unresolved_run_dates_are_refused(text):
    with pytest.raises(ValueError):
        parse_run_date(text)


def test_nightly_run_balances_and_can_be_repeated(lake):
    spark = lake.spark
    sources = {t: mapping.source(spark, SF, t) for t in mapping.TABLES}
    calendar = (date(1995, 1, 1), date(2030, 12, 31))
    gold = run_nightly(lake, sources, "2025-03-01", calendar, halt_on_critical=False)
    log = read_run_log(lake)
    assert log.filter("status <> 'SUCCESS'").select("phase", "status").distinct().collect() in ([], [("warehouse", "LOW")])
    assert log.count() == 6 + 6 + 11 + 1 + 11

    outcomes = lake.read_log("dq_results", OUTCOME_SCHEMA, "json")
    assert outcomes.count() == 4 + 5 + 7 + 7 + 7 + 7
    assert outcomes.filter("outcome IS NULL OR run_date IS NULL OR failed_rows IS NULL").count() == 0

    bronze = {t: lake.read("bronze", t) for t in mapping.TABLES}
    silver = {t: lake.read("silver", t) for t in mapping.TABLES}
    quarantine = {t: lake.read("quarantine", t) for t in mapping.TABLES if t != "branches"}
    checks_of = {(t, z): df.count() for z, zone in (("bronze", bronze), ("silver", silver), ("quarantine", quarantine)) for t, df in zone.items()}
    balance = checks.reconcile(bronze, silver, quarantine)
    assert balance.filter("lost_rows <> 0").count() == 0
    assert {t: silver[t].count() for t in silver} == {
        "branches": 25, "customers": 140, "accounts": 139, "transactions": 1496, "payment_gateway_logs": 990, "credit_bureau_reports": 281,
    }
    fact = gold["fact_transactions"]
    total = fact.agg(F.sum("amount")).first()[0]
    for table, column in (("agg_monthly_summary", "total_txn_volume"), ("agg_branch_performance", "total_txn_volume"), ("agg_customer_360", "lifetime_txn_volume")):
        assert gold[table].agg(F.sum(column)).first()[0] == total
    assert sorted(r.txn_sk for r in fact.select("txn_sk").collect()) == list(range(1, 1497))
    view = views.build_views(gold)["vw_branch_performance"]
    known = fact.filter("branch_sk <> 0").agg(F.sum("amount")).first()[0]
    assert view.agg(F.sum("total_volume_inr")).first()[0] == known
    assert lake.current("warehouse", "fact_transactions").count() == 1496

    # The same date once more replaces its own load.
    run_nightly(lake, sources, "2025-03-01", calendar, halt_on_critical=False)
    for zone in ("bronze", "silver", "quarantine"):
        before = {"bronze": bronze, "silver": silver, "quarantine": quarantine}[zone]
        assert {t: lake.read(zone, t).count() for t in before} == {t: checks_of[t, zone] for t in before}

    again = run_nightly(lake, sources, "2025-03-02", calendar, halt_on_critical=False)
    keys = [c for c in fact.columns if c not in ("gold_load_ts",)]
    assert rows(again["fact_transactions"], *keys) == rows(fact, *keys)
    assert again["dim_customer"].count() == gold["dim_customer"].count()


def test_a_failing_source_keeps_the_former_gold(lake, capsys):
    spark = lake.spark
    sources = {t: mapping.source(spark, SF, t) for t in mapping.TABLES}
    gold = run_nightly(lake, sources, "2025-03-01", halt_on_critical=False)
    # Without a calendar it spans the data.
    assert gold["fact_transactions"].filter("date_sk = 0").count() == 0
    published = rows(lake.versions())
    sources["payment_gateway_logs"] = sources["payment_gateway_logs"].limit(0)
    with pytest.raises(RunStopped, match="payment_gateway_logs"):
        run_nightly(lake, sources, "2025-03-02", halt_on_critical=False)
    assert "delivered no rows" in capsys.readouterr().out
    second = read_run_log(lake).filter("run_ts = timestamp '2025-03-02'")
    assert run_status(second).first().status == "PARTIAL"
    assert "EmptySource" in second.filter("status = 'FAILED'").first().error
    assert second.filter("phase = 'gold'").count() == 0 and rows(lake.versions()) == published


def test_a_critical_rule_stops_the_run(lake):
    spark = lake.spark
    sources = {t: mapping.source(spark, SF, t) for t in mapping.TABLES}
    with pytest.raises(RunStopped, match="transactions"):  # every 997th comes twice
        run_nightly(lake, sources, "2025-03-01")
    assert lake.read("quarantine", "transactions").count() > 0
    assert lake.versions().count() == 0


def test_a_changed_branch_gets_a_version(lake):
    spark = lake.spark
    shape = "branch_code string, branch_name string, city string, state string, region string, created_at timestamp, load_timestamp timestamp"
    first, second = datetime(2025, 3, 1), datetime(2025, 3, 2)
    states = [("A", "Zeta", "c", "s", "r", datetime(2020, 1, 1), first), ("A", "Alpha", "c", "s", "r", datetime(2020, 1, 1), second), ("B", "b", "c", "s", "r", datetime(2021, 1, 1), first), ("B", "b", "c", "s", "r", datetime(2021, 1, 1), second)]
    dim = build_dim_branch(spark.createDataFrame(states, shape), RUN)
    assert rows(dim, "branch_code", "branch_name", "effective_from", "effective_to", "is_current") == [
        ("A", "Alpha", second, None, 1), ("A", "Zeta", datetime(2020, 1, 1), second, 0), ("B", "b", datetime(2021, 1, 1), None, 1),
    ]


def test_checks(spark):
    df = spark.createDataFrame(
        [("a" * 32, 1, "b", "s", RUN), ("XYZ", 0, None, "s", RUN)],
        "row_hash string, is_active int, batch_id string, src_system string, load_timestamp timestamp",
    )
    got = rows(checks.check_bronze(df, "t", 3), "check_name", "failures", "status")
    assert got == [("audit_not_null", 1, "FAIL"), ("is_active", 1, "FAIL"), ("min_rows", 1, "FAIL"), ("row_hash", 1, "FAIL")]
    assert checks.missing(["a", "b"], ["b"]) == ["a"]
    assert rows(checks.check_columns(df, "t", ["row_hash", "nope"]), "failures") == [(1,)]
    assert rows(checks.check_types(df, "t", {"is_active": "int", "load_timestamp": "timestamp"}), "status") == [("PASS",)]
    branches = spark.createDataFrame([("BR005",)], "branch_code string")
    assert rows(checks.check_source(branches, "b", "branch_code", "BR005", 1), "status") == [("PASS",), ("PASS",)]
    assert rows(checks.check_source(branches, "b", "branch_code", "BR006", 1), "check_name", "status") == [("has:BR006", "FAIL"), ("min_rows", "PASS")]
    report = checks.layer_report([checks.check_bronze(df, "t", 3), checks.check_columns(df, "t", ["row_hash"])])
    assert rows(report, "table_name", "rows", "checks", "failed_checks", "status") == [("t", 2, 5, 4, "FAIL")]


def test_landing_types_cover_the_source():
    assert landing_types("payment_gateway_logs")["processing_time_ms"] == "bigint"
    assert landing_types("credit_bureau_reports")["external_overdue_amount"] == "decimal"

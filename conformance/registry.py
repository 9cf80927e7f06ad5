"""Every operator and report as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance import mapping, nights
from conformance.workspace import CALENDAR, RUN_TS, Gold, Workspace, workspace
from tellerlake.functions.casting import enforce_types, normalize_ts
from tellerlake.functions.hashing import row_hash
from tellerlake.functions.masking import mask_by_catalog, mask_pii, pii_leak
from tellerlake.operators.aggregates import distinct_values, fk_miss, null_counts, value_range
from tellerlake.operators.joins import asof_dim, current, orphan_keys, orphans
from tellerlake.operators.keys import assign_sk, extend_sk
from tellerlake.operators.merge import dedupe, insert_only, soft_delete, union_loads, upsert
from tellerlake.operators.scd2 import scd2, scd2_apply, scd2_apply_keyed
from tellerlake.operators.windows import changed, dod_change, duplicate_keys, flag_unique
from tellerlake.plans import checks, dims, facts, nightly, observability, views
from tellerlake.plans.incremental import incremental_run, read_merged
from tellerlake.plans.nightly import run_nightly
from tellerlake.plans.reports import REPORTS
from tellerlake.plans.silver import SPEC, quarantine_stats, reprocess
from tellerlake.quality import engine
from tellerlake.quality.rules import FOREIGN_KEYS, FORMAT_RULES, RULES, KeyRule, foreign_key_rules, rules_from_catalog
from tellerlake.schemas import CATALOG, WAREHOUSE, landing_types
from tellerlake.session import in_parallel, scratch_path, settle, settle_keys
from tellerlake.sources import lake as lakes
from tellerlake.sources.files import batch_manifest, load_files
from tellerlake.sources.landing import Batch, RelationalTable, add_audit_columns, read_landing_csv, read_relational
from tellerlake.sources.lake import Lake
from tellerlake.sources.state import incremental, read_run_log, run_status, watermark_report
from tellerlake.sources.warehouse import load_all
from tellerlake.streaming.bursts import alert_bursts, failure_burst, read_bursts
from tellerlake.streaming.ingest import landing_stream, run_to_end, stream_bronze
from tellerlake.streaming.quality import stream_dq

Query = Callable[[SparkSession, str], DataFrame]

# Columns that only say when and by which run a row was made.
STAMPS = [
    "load_date", "silver_load_ts", "silver_layer", "dq_status", "quarantine_ts", "quarantine_reason", "gold_load_ts", "gold_layer",
]


def portable(df: DataFrame) -> DataFrame:
    """Result types that both engines print alike: dates and times (to the microsecond) as text, money as double."""
    out = []
    for f in df.schema:
        kind, c = f.dataType.typeName(), F.col(f.name)
        if kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "decimal":
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def _source_columns(table: str) -> list[str]:
    return [name for name, _ in mapping.COLUMNS[table]]


def _keys(table: str) -> list[str]:
    return {"credit_bureau_reports": ["customer_id", "bureau_pull_date"]}.get(table) or [_source_columns(table)[0]]


# --- bronze, typing, masking ------------------------------------------------------------------


def _bronze(w: Workspace, table: str) -> DataFrame:
    batch = Batch("batch-1", RUN_TS, "core_banking", src_table=table, load_type="FULL_MERGE")
    return add_audit_columns(w.source(table), batch).select(*_keys(table), "row_hash", "is_active", "pipeline_phase")


def _payments_text(w: Workspace) -> DataFrame:
    return mapping.read(w.spark, w.sf_dir, "events").selectExpr(
        "concat(' ', cast(event_id + 1 AS string)) AS txn_id",
        "concat(event_type, ' ') AS gateway_status",
        "CASE WHEN event_id % 50 = 0 THEN 'abc' WHEN event_id % 51 = 0 THEN '' ELSE cast(cast(value * 20 AS decimal(18,2)) AS string) END AS processing_time_ms",
        "CASE WHEN event_id % 77 = 0 THEN 'not a time' ELSE cast(ts AS string) END AS processed_timestamp",
    )


_PAYMENT_TYPES = {"txn_id": "bigint", "gateway_status": "string", "processing_time_ms": "bigint", "processed_timestamp": "timestamp"}


def _write_landing(w: Workspace) -> str:
    """Payment logs as landing CSV files, all text."""
    path = scratch_path(w.spark, "landing")
    rows = w.source("payment_gateway_logs")
    text = rows.select([F.col(c).cast("string").alias(c) for c in rows.columns])
    text.write.option("header", "true").csv(path)
    return path


def _landing_csv(w: Workspace) -> DataFrame:
    types = landing_types("payment_gateway_logs")
    typed = enforce_types(read_landing_csv(w.spark, _write_landing(w), list(types)), types)
    return typed.drop("src_file_name").withColumn("row_hash", row_hash(*types))


# Fields of a landing line; every 40th line gets a field too many, every 41st loses its last two.
_LINE = ["cast(event_id + 1 as string)", "event_type", "cast(floor(value * 20) as string)", "cast(user_id as string)"]
_LINE_TYPES = {"txn_id": "bigint", "kind": "string", "processing_time_ms": "bigint", "payer": "bigint"}


def _landing_lines(w: Workspace, path: str, where: str) -> None:
    """Lines of the events as two files in a folder."""
    short, whole = f"concat_ws(',', {', '.join(_LINE[:2])})", f"concat_ws(',', {', '.join(_LINE)})"
    line = F.expr(f"case when event_id % 40 = 0 then concat({whole}, ',surplus') when event_id % 41 = 0 then {short} else {whole} end")
    mapping.read(w.spark, w.sf_dir, "events").filter(where).repartition(2).select(line).write.text(path)


def _file_loads(w: Workspace) -> Lake:
    """Three loads of a folder: two files, the same and two files with older rows, and nothing new."""

    def make() -> Lake:
        lake, landing = Lake(w.spark, scratch_path(w.spark, "files")), scratch_path(w.spark, "landing")
        loads = [("b1", "event_id % 3 <> 0"), ("b2", "event_id % 3 = 0"), ("b3", None)]
        for day, (batch, where) in enumerate(loads):
            if where:
                _landing_lines(w, f"{landing}/{batch}", where)
            load_files(lake, "gateway", landing, _LINE_TYPES, batch, datetime(2025, 3, 1 + day), "*.txt", header=False)
        return lake

    key = (id(w), "files")
    if key not in _lakes:
        _lakes[key] = make()
    return _lakes[key]


def _corrupt_lines(w: Workspace) -> DataFrame:
    return _file_loads(w).read("quarantine", "gateway_lines").select("line", "quarantine_reason", "batch_id")


def _file_rows(w: Workspace) -> DataFrame:
    return _file_loads(w).read("bronze", "gateway").select(*_LINE_TYPES, "batch_id", "src_system")


def _stream_ingest(w: Workspace) -> DataFrame:
    types = landing_types("payment_gateway_logs")
    stream = landing_stream(w.spark, _write_landing(w), types, "*.csv")
    target, checkpoint = scratch_path(w.spark, "bronze"), scratch_path(w.spark, "checkpoint")
    run_to_end(stream_bronze(stream, target, checkpoint))
    return w.spark.read.parquet(target).select(*types, "row_hash")


def _stream_dq(w: Workspace) -> DataFrame:
    spark = w.spark
    schema = mapping.read(spark, w.sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(w.sf_dir)
    # Every 997th event is delivered twice.
    times = F.when(F.col("event_id") % 997 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    stream = events.withColumn("_copy", F.explode(times)).selectExpr(*mapping.columns("payment_gateway_logs"))
    silver, quarantine = scratch_path(spark, "silver"), scratch_path(spark, "quarantine")
    run_to_end(stream_dq(stream, RULES["payment_gateway_logs"], silver, quarantine, scratch_path(spark, "checkpoint"), ["txn_id"], SPEC["payment_gateway_logs"]))
    return spark.read.parquet(silver).select(*_source_columns("payment_gateway_logs"))


# --- quality ----------------------------------------------------------------------------------


def _outcomes(w: Workspace, table: str) -> DataFrame:
    return w.checked(table).outcomes


def _all_outcomes(w: Workspace) -> DataFrame:
    """Outcomes of all tables, worked out once: several reports read them."""

    def make() -> DataFrame:
        parts = in_parallel({t: lambda t=t: _outcomes(w, t) for t in mapping.TABLES})
        return reduce(DataFrame.unionAll, [parts[t] for t in mapping.TABLES])

    return _once(w, "outcomes", make)


def _all_rows(w: Workspace) -> DataFrame:
    return engine.row_results(_all_outcomes(w))


_kept: dict[tuple[int, str], DataFrame] = {}


def _once(w: Workspace, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    key = (id(w), name)
    if key not in _kept:
        _kept[key] = settle_keys(make())
    return _kept[key]


def _dq_rows(w: Workspace, table: str) -> DataFrame:
    return w.checked(table).evaluated.select(*_keys(table), engine.reason_text(RULES[table]).alias("broken_rules"))


def _silver(w: Workspace, table: str) -> DataFrame:
    return w.checked(table).silver.drop(*STAMPS)


def _quarantine(w: Workspace, table: str) -> DataFrame:
    return w.checked(table).quarantine.drop(*STAMPS)


def _foreign_keys(w: Workspace) -> DataFrame:
    parts = []
    for child, column, parent, parent_column in FOREIGN_KEYS:
        bad = orphan_keys(w.source(child), column, w.silver(parent), parent_column)
        parts.append(
            bad.agg(F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows")).select(
                F.lit(child).alias("child"), F.lit(column).alias("fk_column"), F.lit(parent).alias("parent"), "orphan_keys", "orphan_rows"
            )
        )
    return reduce(DataFrame.unionAll, parts)


def _fk_rows(w: Workspace) -> DataFrame:
    rules = foreign_key_rules("transactions")
    rows = engine.evaluate_rows(w.source("transactions"), rules, {"accounts": w.silver("accounts")})
    return rows.select("txn_id", "account_id", engine.reason_text(rules).alias("broken_rules"))


def _strict(w: Workspace, table: str) -> DataFrame:
    """Rows of a table refined after its parents, with the rules they broke; formats and foreign keys among them."""

    def make() -> Lake:
        lake = Lake(w.spark, scratch_path(w.spark, "strict"))
        run = nightly.Run(lake, RUN_TS, "strict", [])
        sources = {t: w.source(t) for t in ("branches", "customers", "accounts", "transactions")}
        nightly.in_levels(sources, lambda t, s: nightly.ingest(run, t, s) and nightly.refine(run, t, False, True) >= 0, True)
        return lake

    key = (id(w), "strict")
    if key not in _lakes:
        _lakes[key] = make()
    lake, columns = _lakes[key], [mapping.COLUMNS[table][0][0]]
    passed = lake.read("silver", table).select(*columns, F.lit("").alias("broken_rules"))
    return passed.unionByName(lake.read("quarantine", table).select(*columns, "broken_rules"))


def _formats(w: Workspace) -> DataFrame:
    rows = engine.evaluate_rows(w.source("customers"), FORMAT_RULES)
    return rows.select("customer_id", engine.reason_text(FORMAT_RULES).alias("broken_rules"))


def _catalog_rules(w: Workspace) -> DataFrame:
    rules = rules_from_catalog(CATALOG["transactions"])
    return engine.evaluate_rules(w.source("transactions"), rules, "transactions", "2025-03-01").drop("run_date", "failed_rows")


def _reprocess(w: Workspace) -> DataFrame:
    fixed = reprocess(
        w.checked("accounts").quarantine, SPEC["accounts"],
        lambda df: df.withColumn("balance", F.greatest("balance", F.lit(0).cast("decimal(18,2)"))), RUN_TS,
    )
    return fixed.silver.drop(*STAMPS)


def _audited(w: Workspace, table: str) -> DataFrame:
    return add_audit_columns(w.source(table), Batch("batch-1", RUN_TS, "core_banking", src_table=table, load_type="FULL_MERGE"))


def _reconcile_written(w: Workspace) -> DataFrame:
    """Written bronze against written silver and quarantine of a strict run."""
    _strict(w, "transactions")
    lake, tables = _lakes[(id(w), "strict")], ("branches", "customers", "accounts", "transactions")
    return checks.reconcile(*[{t: lake.read(z, t) for t in tables} for z in ("bronze", "silver", "quarantine")])


def _reconcile(w: Workspace) -> DataFrame:
    tables = mapping.TABLES
    return checks.reconcile(
        {t: w.bronze(t) for t in tables}, {t: w.checked(t).silver for t in tables}, {t: w.checked(t).quarantine for t in tables}
    )


# --- history ----------------------------------------------------------------------------------

_TRACKED = ["branch_code", "kyc_status"]
_VERSION = ["customer_id", *_TRACKED, "attr_hash", "effective_from", "effective_to", "is_current"]
_STATE = ["customer_id", *_TRACKED, "updated_at"]


def _history(w: Workspace) -> DataFrame:
    moved = mapping.moved_customers(w.spark, w.sf_dir)
    return w.source("customers").select(*_STATE).unionByName(moved.select(*_STATE))


def _scd2(w: Workspace) -> DataFrame:
    return scd2(_history(w), ["customer_id"], _TRACKED, "updated_at").select(*_VERSION)


def _scd2_batch(w: Workspace) -> DataFrame:
    first = scd2(w.source("customers").select(*_STATE), ["customer_id"], _TRACKED, "updated_at")
    batch = mapping.moved_customers(w.spark, w.sf_dir).select(*_STATE)
    return scd2_apply(first, batch, ["customer_id"], _TRACKED, "updated_at").select(*_VERSION)


def _scd2_stable_keys(w: Workspace) -> DataFrame:
    first = scd2(w.source("customers").select(*_STATE), ["customer_id"], _TRACKED, "updated_at")
    dim = settle(assign_sk(settle(first, "versions"), ["customer_id", "effective_from"], "customer_sk", as_type="int"), "dim")
    batch = mapping.moved_customers(w.spark, w.sf_dir).select(*_STATE)
    return scd2_apply_keyed(dim, batch, ["customer_id"], _TRACKED, "updated_at", "customer_sk").select("customer_sk", *_VERSION)


def _changed(w: Workspace) -> DataFrame:
    states = _history(w).withColumn("attr_hash", row_hash(*_TRACKED))
    return changed(states, ["customer_id"], "updated_at", "attr_hash").select(*_STATE)


def _asof(w: Workspace) -> DataFrame:
    """Customer version at the time of each order, orders moved into the time of the versions."""
    orders = mapping.read(w.spark, w.sf_dir, "orders").selectExpr(
        "o_orderkey", "cast(o_custkey + 1 AS int) AS customer_id", "cast(o_orderdate + INTERVAL '9000' DAY AS timestamp) AS at"
    )
    valid = asof_dim(orders, _scd2(w), ["customer_id"], "at", _TRACKED)
    return valid.select("o_orderkey", F.col("customer_id").cast("bigint").alias("customer_id"), *_TRACKED)


# --- incremental ------------------------------------------------------------------------------

_SPLIT = datetime(2000, 1, 1)


def _incremental_pull(w: Workspace) -> DataFrame:
    rows = w.source("transactions")
    mark = rows.filter(F.col("txn_timestamp") < F.lit(_SPLIT)).agg(F.max("txn_timestamp")).first()[0]
    return incremental(rows, "txn_timestamp", mark)


def _upsert_accounts(w: Workspace) -> DataFrame:
    target = w.source("accounts")
    changed_rows = target.filter("account_id % 10 = 0").withColumns(
        {"balance": (F.col("balance") + 100).cast("decimal(18,2)"), "updated_at": F.lit(datetime(2024, 4, 1))}
    )
    new = target.filter("account_id % 50 = 0").withColumn("account_id", F.col("account_id") + 1000000000)
    merged = upsert(target, changed_rows.unionByName(new), ["account_id"], ["updated_at"])
    return merged.select("account_id", "customer_id", "balance", "status", "updated_at")


def _loads(w: Workspace) -> tuple[DataFrame, DataFrame]:
    """Historical and incremental file of the transactions, half a year of them in both."""
    rows = w.source("transactions")
    return rows.filter("txn_timestamp < timestamp '2000-01-01'"), rows.filter("txn_timestamp >= timestamp '1999-07-01'")


def _insert_only(w: Workspace) -> DataFrame:
    first, second = _loads(w)
    once = settle(dedupe(first, ["txn_id"], ["txn_timestamp"]), "once")
    return insert_only(once, second, ["txn_id"], ["txn_timestamp"])


def _extend_keys(w: Workspace) -> DataFrame:
    people = w.source("customers").select("customer_id")
    known = settle(assign_sk(people.filter("customer_id % 10 <> 0"), ["customer_id"], "sk"), "known")
    return extend_sk(known, people, ["customer_id"], "sk")


def _merged_customers(w: Workspace) -> tuple[Lake, DataFrame]:
    """Two loads of the customers through the incremental run, the second one repeated."""

    def make() -> Lake:
        lake = Lake(w.spark, scratch_path(w.spark, "incremental"))
        moved = mapping.moved_customers(w.spark, w.sf_dir)
        incremental_run(lake, "customers", w.source("customers"), "b1", datetime(2025, 3, 1))
        incremental_run(lake, "customers", moved, "b2", datetime(2025, 3, 2))
        return lake

    key = (id(w), "merged")
    if key not in _lakes:
        _lakes[key] = make()
    return _lakes[key], read_merged(_lakes[key], "customers")


_lakes: dict[tuple[int, str], Lake] = {}


# --- observability ----------------------------------------------------------------------------


def _extended_fact(w: Workspace) -> DataFrame:
    """Fact of the transactions before 2000 plus the rows that the later load adds."""

    def make() -> DataFrame:
        gold = w.gold("dim_account"), w.gold("dim_date")
        silver = w.silver("transactions")
        old = settle(silver.filter("txn_timestamp < timestamp '2000-01-01'"), "old")
        fact = settle(facts.build_fact_transactions(old, *gold, RUN_TS), "fact")
        late = silver.filter("txn_timestamp >= timestamp '1999-07-01'")
        return fact.unionByName(facts.extend_fact_transactions(fact, late, *gold, RUN_TS))

    return make().select("txn_sk", "txn_id", "account_sk", "amount", "txn_date")


def _stream_bursts(w: Workspace) -> DataFrame:
    spark = w.spark
    schema = mapping.read(spark, w.sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(w.sf_dir)
    runs = events.selectExpr(*mapping.columns("job_runs")).withColumnRenamed("run_ts", "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    target = scratch_path(spark, "bursts")
    run_to_end(alert_bursts(failure_burst(runs), target, scratch_path(spark, "checkpoint")))
    return read_bursts(spark.read.parquet(target))


def _nightly_log(w: Workspace) -> DataFrame:
    lake = Lake(w.spark, scratch_path(w.spark, "nightly"))
    run_nightly(lake, {t: w.source(t) for t in mapping.TABLES}, "2025-03-01", CALENDAR, halt_on_critical=False)
    return read_run_log(lake).select("phase", "step", "status", "rows")


def _extract(w: Workspace) -> DataFrame:
    table = RelationalTable("customer", ("c_custkey", "c_name", "c_nationkey"), "c_custkey", path=f"{w.sf_dir}/customer.parquet")
    return read_relational(w.spark, table)


def _verified_write(w: Workspace) -> DataFrame:
    path = scratch_path(w.spark, "verified")
    lakes.write_verified(w.source("transactions"), path)
    return w.spark.read.parquet(path)


def _daily_counts(w: Workspace) -> DataFrame:
    parts = [
        w.gold(t).groupBy(F.col("txn_date").alias("day")).agg(F.count(F.lit(1)).alias("value")).select(F.lit(t).alias("table_name"), "day", "value")
        for t in ("fact_transactions", "fact_payments")
    ]
    return reduce(DataFrame.unionAll, parts)


def _dense_counts(w: Workspace) -> DataFrame:
    """Rows per table and day with planted days on which nothing came, and a fact that stopped coming."""
    counts = _daily_counts(w).filter("day(day) <> 13")
    return observability.dense_days(counts, "value", until="2024-02-15")


def _quality_trend(w: Workspace) -> DataFrame:
    """Each day of the transactions as a load of its own, checked by the rules of single rows."""
    rules = [r for r in RULES["transactions"] if not isinstance(r, KeyRule)]
    rows = engine.evaluate_rows(w.source("transactions"), rules).withColumn("run_date", F.to_date("txn_timestamp"))
    days = rows.groupBy(F.lit("transactions").alias("table_name"), "run_date").agg(
        F.count(F.lit(1)).alias("evaluated_rows"), F.count_if(~F.col("dq_passed")).alias("failed_rows")
    )
    return observability.quality_trend(days.withColumn("rule_no", F.lit(1)))


def _hourly_runs(w: Workspace) -> DataFrame:
    """The job log as pipeline runs: all jobs that start in an hour are steps of one run."""
    runs = w.source("job_runs").withColumn("started_at", F.col("run_ts"))
    return runs.withColumn("batch_id", F.date_format("started_at", "yyyy-MM-dd HH"))


def _rounded(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in cols})


def _anomalies(w: Workspace) -> DataFrame:
    return observability.row_anomalies(_daily_counts(w))


def _job_days(w: Workspace) -> DataFrame:
    runs = w.source("job_runs")
    return runs.groupBy(F.col("step").alias("table_name"), F.to_date("run_ts").alias("day")).agg(F.max("duration_s").alias("value"))


def _metrics(w: Workspace) -> DataFrame:
    rows = _all_rows(w).withColumn("day", F.lit(RUN_TS.date()))
    return observability.metrics(_all_outcomes(w), rows, w.source("job_runs"))


def _runs_by_step(w: Workspace) -> DataFrame:
    return run_status(w.source("job_runs").withColumn("batch_id", F.col("step")))


# --- checks, sinks, catalog -------------------------------------------------------------------


def _warehouse(w: Workspace) -> DataFrame:
    return load_all(Lake(w.spark, scratch_path(w.spark, "warehouse")), w.all_gold())


def _checks_report(w: Workspace) -> DataFrame:
    results = []
    for t in mapping.TABLES:
        batch = Batch("batch-1", RUN_TS, "core_banking", src_table=t, load_type="FULL_MERGE")
        results.append(checks.check_bronze(add_audit_columns(w.source(t), batch), f"bronze.{t}", 5))
        results.append(checks.check_silver(w.silver(t), f"silver.{t}", 5))
    for t in WAREHOUSE:
        results.append(checks.check_columns(w.gold(t), f"gold.{t}", dims.columns_of(t)))
        if not t.startswith("agg_"):
            results.append(checks.check_gold(w.gold(t), f"gold.{t}", dims.columns_of(t)[0], 1))
    return checks.layer_report(results)


def _inventory(w: Workspace) -> DataFrame:
    return lakes.zone_inventory(w.spark, w.lake.base)


def _registered(w: Workspace) -> DataFrame:
    names = lakes.register_zone(w.lake, "gold", list(WAREHOUSE), "gold_")
    counts = [w.spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n.removeprefix("gold_")).alias("table_name"), "row_count") for n in names]
    return reduce(DataFrame.unionAll, counts)


# --- the registry -----------------------------------------------------------------------------

Build = Callable[[Workspace], DataFrame]


def builds() -> dict[str, Build]:
    q: dict[str, Build] = {}
    for t in mapping.TABLES:
        q[f"bronze_audit_{t}"] = lambda w, t=t: _bronze(w, t)
        q[f"dq_rows_{t}"] = lambda w, t=t: _dq_rows(w, t)
        q[f"dq_rules_{t}"] = lambda w, t=t: _outcomes(w, t).drop("run_date", "failed_rows")
        q[f"silver_{t}"] = lambda w, t=t: _silver(w, t)
        q[f"quarantine_{t}"] = lambda w, t=t: _quarantine(w, t)
    for t in WAREHOUSE:
        q[t] = lambda w, t=t: w.plan(t).drop(*STAMPS)
    q["dim_date"] = lambda w: dims.calendar_of(mapping.read(w.spark, w.sf_dir, "orders"), "o_orderdate")

    # typing, masking, landing
    q["enforce_types_payments"] = lambda w: enforce_types(_payments_text(w), _PAYMENT_TYPES)
    q["enforce_types_zero"] = lambda w: enforce_types(_payments_text(w), _PAYMENT_TYPES, on_bad="zero").select("txn_id", "processing_time_ms")
    q["normalize_timestamps"] = lambda w: normalize_ts(
        enforce_types(_payments_text(w), {"txn_id": "bigint"}).select("txn_id", "processed_timestamp"), ["processed_timestamp"]
    )
    masked = ["customer_id", "pan_masked", "email_masked", "phone_masked"]
    q["mask_customers"] = lambda w: mask_pii(w.source("customers")).select(*masked)
    q["mask_customers_alternative"] = lambda w: mask_pii(w.source("customers"), "readme").select(*masked)
    q["mask_by_catalog"] = lambda w: mask_by_catalog(w.source("customers"), CATALOG["customers"]).drop("branch_code", "created_at", "updated_at")
    q["pii_leak_check"] = lambda w: pii_leak(w.silver("customers"))
    q["landing_csv_payments"] = _landing_csv
    q["landing_csv_corrupt"] = _corrupt_lines
    q["landing_files_rows"] = _file_rows
    q["batch_manifest"] = lambda w: batch_manifest(_file_loads(w), ["gateway"]).drop("last_modified")
    q["stream_ingest"] = _stream_ingest
    q["stream_dq"] = _stream_dq

    # quality
    q["dq_foreign_keys"] = _foreign_keys
    q["dq_fk_rows_transactions"] = _fk_rows
    q["orphan_transactions"] = lambda w: orphans(w.source("transactions"), "account_id", w.silver("accounts"), "account_id")
    for t in ("customers", "accounts", "transactions"):
        q[f"strict_rows_{t}"] = lambda w, t=t: _strict(w, t)
    q["dq_formats"] = _formats
    q["dq_duplicates"] = lambda w: duplicate_keys(w.source("transactions"), ["txn_id"])
    q["unique_flags_transactions"] = lambda w: flag_unique(w.source("transactions"), ["txn_id"]).select(
        "txn_id", "account_id", F.col("is_unique").cast("int").alias("is_unique")
    )
    q["dq_catalog_rules"] = _catalog_rules
    q["quarantine_stats"] = lambda w: quarantine_stats({t: w.checked(t).quarantine for t in mapping.TABLES})
    q["dq_pass_rate"] = lambda w: engine.dq_pass_rate(_all_rows(w))
    q["dq_rule_pass_rate"] = lambda w: engine.rule_pass_rate(_all_outcomes(w))
    q["dq_gate"] = lambda w: engine.dq_gate(_all_rows(w), _all_outcomes(w))
    q["top_failing_rules"] = lambda w: observability.top_failing_rules(_all_outcomes(w))
    q["reprocess_accounts"] = _reprocess
    q["reprocess_written_back"] = nights.reprocessed
    q["reconcile_layers"] = _reconcile
    q["reconcile_written"] = _reconcile_written
    q["check_bronze"] = lambda w: reduce(DataFrame.unionByName, [checks.check_bronze(_audited(w, t), t, 5) for t in mapping.TABLES])
    q["check_silver"] = lambda w: reduce(DataFrame.unionByName, [checks.check_silver(w.silver(t), t, 5) for t in mapping.TABLES])
    q["check_source_branches"] = lambda w: checks.check_source(w.source("branches"), "branches", "branch_code", "BR001", 5)
    q["null_counts_customers"] = lambda w: null_counts(w.source("customers"), _source_columns("customers"))
    q["value_range_transactions"] = lambda w: value_range(w.source("transactions"), "txn_timestamp")
    q["distinct_channels"] = lambda w: distinct_values(w.source("transactions"), "channel")
    q["fk_miss_rate"] = lambda w: fk_miss(w.gold("fact_transactions"), "txn_sk")

    # history
    q["scd2_customer"] = _scd2
    q["scd2_customer_batch"] = _scd2_batch
    q["scd2_customer_stable_keys"] = _scd2_stable_keys
    q["current_customer_versions"] = lambda w: current(_scd2(w))
    q["changed_customer_versions"] = _changed
    q["asof_customer_version"] = _asof

    # views and reports
    q["vw_branch_performance"] = lambda w: views.vw_branch_performance(w.gold("fact_transactions"), w.gold("dim_branch"))
    risk = ("dim_customer", "dim_branch", "fact_credit_risk", "agg_customer_360")
    q["vw_customer_risk_profile"] = lambda w: views.vw_customer_risk_profile(*[w.gold(t) for t in risk])
    q["risk_profile_latest"] = lambda w: views.vw_customer_risk_profile(*[w.gold(t) for t in risk], latest_only=True).select(
        "customer_id", "bureau_pull_date", "credit_score", "bank_risk_category"
    )
    q["vw_daily_txn_summary"] = lambda w: views.vw_daily_txn_summary(w.gold("fact_transactions"), w.gold("dim_date"), w.gold("dim_branch"))
    q["vw_payment_channel_analysis"] = lambda w: views.vw_payment_channel_analysis(w.gold("fact_payments"), w.gold("dim_date"))
    arguments = {"q_quarterly": {"year": 1998}, "q_filtered_branch_year": {"branch_name": "NATION_3", "year": 1998}}
    for name, report in REPORTS.items():
        if name == "q_row_counts":
            q[name] = lambda w, r=report: r(w.all_gold())
        else:
            q[name] = lambda w, r=report, a=arguments.get(name, {}): r(Gold(w), **a)

    # incremental
    q["incremental_pull"] = _incremental_pull
    q["upsert_accounts"] = _upsert_accounts
    q["insert_only_transactions"] = _insert_only
    q["union_loads_transactions"] = lambda w: union_loads(list(_loads(w)), ["txn_id"], ["txn_timestamp"])
    q["latest_transactions"] = lambda w: dedupe(w.source("transactions"), ["txn_id"], ["txn_timestamp"])
    q["extended_fact_transactions"] = _extended_fact
    q["soft_delete_accounts"] = lambda w: soft_delete(
        w.source("accounts"), w.source("accounts").filter("account_id % 13 <> 0"), ["account_id"]
    ).select("account_id", "is_active")
    q["extend_surrogate_keys"] = _extend_keys
    q["incremental_merge_customers"] = lambda w: _merged_customers(w)[1].select("customer_id", "branch_code", "updated_at")
    q["watermark_report"] = lambda w: watermark_report(_merged_customers(w)[0]).filter("source = 'customers'")

    q["incremental_future_row"] = nights.future_row
    q["rerun_same_date"] = nights.rerun
    q["nightly_second_run"] = nights.second_run
    q["second_night_daily_balances"] = lambda w: nights.two_nights(w)[1]["agg_daily_balances"].drop("account_sk", *STAMPS)
    q["second_night_monthly_summary"] = lambda w: nights.two_nights(w)[1]["agg_monthly_summary"].drop("branch_sk", *STAMPS)
    q["second_night_branch_performance"] = lambda w: nights.two_nights(w)[1]["agg_branch_performance"].drop("branch_sk", *STAMPS)
    q["second_night_customer_360"] = lambda w: nights.second_customers(w).drop(*STAMPS)
    q["second_night_parts"] = nights.written_parts

    # observability
    q["anomaly_daily_counts"] = lambda w: _rounded(_anomalies(w), ["baseline_mean", "baseline_stddev", "lower_bound", "upper_bound"])
    q["anomaly_alerts"] = lambda w: observability.alert_rows(_anomalies(w))
    q["duration_anomalies"] = lambda w: _rounded(observability.duration_anomalies(_job_days(w)), ["baseline_mean"]).select(
        "table_name", "day", "value", "baseline_mean", "is_anomaly"
    )
    q["dod_change"] = lambda w: _rounded(dod_change(_daily_counts(w), ["table_name"], "day", "value"), ["change_pct"])
    q["deviation_rules"] = lambda w: observability.deviation(_daily_counts(w), "value").select("table_name", "day", "value", "dropped", "off_baseline")
    q["metrics_table"] = _metrics
    q["alerts_thresholds"] = lambda w: observability.alerts(_metrics(w), observability.thresholds_df(w.spark))
    q["stream_failure_burst"] = _stream_bursts
    q["failure_burst"] = lambda w: observability.failure_bursts(w.source("job_runs"), "run_ts")
    q["concurrent_runs"] = lambda w: observability.concurrent_runs(w.source("job_runs").withColumn("duration_s", F.col("duration_s") * 60))
    q["rows_by_zone_day"] = lambda w: observability.rows_by_zone_day(w.source("job_runs").withColumnRenamed("phase", "zone"))
    q["job_trend_30d"] = lambda w: observability.job_trend(w.source("job_runs")).drop("mean_duration_s")
    q["quality_trend_30d"] = _quality_trend
    q["whole_run_metrics"] = lambda w: observability.whole_run_metrics(_hourly_runs(w))
    q["alerts_whole_runs"] = lambda w: observability.alerts(observability.whole_run_metrics(_hourly_runs(w)), observability.thresholds_df(w.spark))
    q["anomaly_dense_days"] = lambda w: _rounded(observability.row_anomalies(_dense_counts(w)), ["baseline_mean", "baseline_stddev", "lower_bound", "upper_bound"])
    q["deviation_dense_days"] = lambda w: observability.deviation(_dense_counts(w), "value").select("table_name", "day", "value", "dropped", "off_baseline")
    q["daily_runs_sla"] = lambda w: observability.daily_runs(w.source("job_runs"))
    q["run_trend_30d"] = lambda w: observability.run_trend(w.source("job_runs"))
    q["last_7_runs"] = lambda w: observability.last_runs(w.source("job_runs").select("batch_id", "run_ts", "status", "duration_s"))
    q["run_status"] = _runs_by_step
    q["rows_by_zone"] = lambda w: observability.rows_by_zone(w.source("job_runs").withColumnRenamed("phase", "zone"))

    # checks, sinks, catalog
    q["nightly_run_log"] = _nightly_log
    q["extract_customers"] = _extract
    q["verified_write"] = _verified_write
    q["warehouse_load"] = _warehouse
    q["check_fact_keys"] = lambda w: checks.check_gold(w.gold("fact_transactions"), "fact_transactions", "txn_sk", 1000)
    q["checks_report"] = _checks_report
    q["profile_gold"] = lambda w: checks.profile_gold(Gold(w))
    q["zone_inventory"] = _inventory
    q["catalog_registration"] = _registered
    return q


def queries() -> dict[str, Query]:
    return {name: lambda spark, sf_dir, b=build: portable(b(workspace(spark, sf_dir))) for name, build in builds().items()}

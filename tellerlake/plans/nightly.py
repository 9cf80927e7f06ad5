"""The nightly run: bronze, silver and quarantine, gold, warehouse."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.operators.merge import dedupe
from tellerlake.plans import aggregates, dims, facts
from tellerlake.plans.silver import LEVELS, SPEC, build_silver, parents_of, strict_rules
from tellerlake.quality.engine import dq_gate, enforce_gate, row_results
from tellerlake.session import in_parallel, settle_keys
from tellerlake.sources.lake import Lake, require_rows
from tellerlake.sources.landing import Batch, add_audit_columns
from tellerlake.sources.parts import part_name
from tellerlake.sources.state import LOAD_POLICY, append_run_log
from tellerlake.sources.warehouse import load_all

_RUN_DATE = re.compile(r"^(\d{4}-\d{2}-\d{2})(T\d{2}:\d{2}(:\d{2})?(\.\d+)?(Z|[+-]\d{2}:\d{2})?)?$")
RELATIONAL = ("branches", "customers", "accounts", "transactions")


def parse_run_date(text: str) -> date:
    """Date of a run given as a date or an ISO time; an unresolved placeholder is refused."""
    found = _RUN_DATE.match(text.strip())
    if not found:
        raise ValueError(f"run date {text!r} is neither a date nor an ISO time")
    return date.fromisoformat(found.group(1))


@dataclass
class Run:
    lake: Lake
    run_ts: datetime
    batch_id: str
    log: list[tuple]

    def step(self, phase: str, name: str, work: Callable[[], int]) -> bool:
        """Do one step and log it with its error; the caller decides what a failure stops."""
        started, error, began = time.monotonic(), None, datetime.now(UTC)
        try:
            rows, status = work(), "SUCCESS"
        except Exception as problem:
            rows, status, error = 0, "FAILED", f"{type(problem).__name__}: {problem}"
            print(f"{phase}.{name} failed: {problem}")
        self.log.append((self.batch_id, self.run_ts, phase, name, status, rows, time.monotonic() - started, error, began))
        return status == "SUCCESS"


class RunStopped(RuntimeError):
    """A run ended early: before gold because a source failed, or after it because the warehouse load did. What was published stays."""


def ingest(run: Run, table: str, source: DataFrame) -> int:
    """Write a load to bronze with its audit columns; a repeated run of a date replaces its load."""
    require_rows(source, table)
    loaded = add_audit_columns(source, batch_of(run, table))
    return own(run, loaded, "bronze", table, ["load_date"])


def batch_of(run: Run, table: str) -> Batch:
    relational = table in RELATIONAL
    return Batch(
        run.batch_id,
        run.run_ts,
        src_system="core_banking" if relational else f"{table}_csv",
        src_table=table if relational else None,
        load_type=LOAD_POLICY[table][0] if relational else None,
    )


def of_day(run: Run) -> Callable[[str], bool]:
    """Which parts belong to the load date."""
    day = run.run_ts.date().isoformat()
    return lambda part: part.split("~")[0] == day


def own(run: Run, df: DataFrame, zone: str, table: str, by: list[str]) -> int:
    """Write the rows of this load date; whatever the date had before goes, even if no row replaces it. Returns the rows of the date."""
    mine = of_day(run)
    part = run.run_ts.date().isoformat() if by == ["load_date"] else part_name(*by)
    entry = run.lake.parts(zone, table).replace(df, part, mine)
    return sum(rows for part, _, rows in entry.folders if mine(part))


def todays(run: Run, zone: str, table: str) -> DataFrame:
    """Rows of this load date; no other folder is opened."""
    return run.lake.parts(zone, table).read(of_day(run))


def refine(run: Run, table: str, halt: bool = True, strict: bool = False) -> int:
    """Check, split and write one table; returns the rows that passed.

    ``strict`` checks formats and foreign keys too, these against the silver rows of the parents. Quarantine and outcomes are written before the gate may halt the table.
    """
    spec = SPEC[table]
    lake = run.lake
    checks = {"rules": strict_rules(table), "parents": {p: lake.read("silver", p) for p in parents_of(table)}} if strict else {}
    result = build_silver(todays(run, "bronze", table), spec, run.run_ts, once=True, **checks)
    outcomes = settle_keys(result.outcomes)
    lake.log(outcomes.withColumn("batch_id", F.lit(run.batch_id)), "dq_results", "json")
    own(run, result.quarantine, "quarantine", table, ["load_date"])
    if halt:
        enforce_gate(dq_gate(row_results(outcomes), outcomes))
    return own(run, result.silver, "silver", table, list(spec.partition_by))


def in_levels(sources: Mapping[str, DataFrame], load: Callable[[str, DataFrame], bool], strict: bool) -> dict[str, bool]:
    """Load the sources side by side; with ``strict`` children wait for their parents, and fail with them."""
    done: dict[str, bool] = {}
    for level in LEVELS if strict else (tuple(sources),):
        ready = {t: sources[t] for t in level if t in sources}
        for t in [t for t in ready if strict and not all(done.get(p, False) for p in parents_of(t))]:
            done[t] = False
            del ready[t]
        done |= in_parallel({t: lambda t=t, s=s: load(t, s) for t, s in ready.items()}) if ready else {}
    return done


def silver_of(lake: Lake, table: str) -> DataFrame:
    """Silver rows of all loads, the last one per key for tables that become facts."""
    rows = lake.read("silver", table)
    if table in ("transactions", "payment_gateway_logs", "credit_bureau_reports"):
        return dedupe(rows, list(LOAD_POLICY[table][2]), ["load_timestamp"])
    return rows


# Gold tables that can be built side by side, in dependency order.
STAGES = (
    ("dim_date", "dim_branch"),
    ("dim_customer",),
    ("dim_account",),
    ("fact_transactions", "fact_payments", "fact_credit_risk"),
    ("agg_daily_balances", "agg_monthly_summary", "agg_branch_performance", "agg_customer_360"),
)
# The calendar holds all days of these columns.
DAYS_OF = {"transactions": "txn_timestamp", "payment_gateway_logs": "processed_timestamp", "credit_bureau_reports": "bureau_pull_date"}
# Clustered by day inside each file, so that day filters skip row groups.
SORTED_BY = {
    "fact_transactions": "txn_date",
    "fact_payments": "txn_date",
    "fact_credit_risk": "bureau_pull_date",
    "agg_daily_balances": "txn_date",
}


def gold_plan(
    name: str,
    silver: Callable[[str], DataFrame],
    gold: Callable[[str], DataFrame],
    spark: SparkSession,
    run_ts: datetime,
    calendar: tuple[date, date],
) -> DataFrame:
    """Plan of one gold table over the written tables it needs."""
    if name == "dim_date":
        return dims.build_dim_date(spark, *calendar)
    if name == "dim_branch":
        return dims.build_dim_branch(silver("branches"), run_ts)
    if name == "dim_customer":
        return dims.build_dim_customer(silver("customers"), gold("dim_branch"), run_ts)
    if name == "dim_account":
        return dims.build_dim_account(silver("accounts"), gold("dim_customer"), gold("dim_branch"), run_ts)
    if name == "fact_transactions":
        return facts.build_fact_transactions(silver("transactions"), gold("dim_account"), gold("dim_date"), run_ts)
    if name == "fact_payments":
        return facts.build_fact_payments(silver("payment_gateway_logs"), gold("dim_date"), run_ts)
    if name == "fact_credit_risk":
        return facts.build_fact_credit_risk(silver("credit_bureau_reports"), gold("dim_customer"), gold("dim_date"), run_ts)
    if name == "agg_daily_balances":
        return aggregates.agg_daily_balances(gold("fact_transactions"), gold("dim_account"), run_ts)
    if name == "agg_monthly_summary":
        return aggregates.agg_monthly_summary(gold("fact_transactions"), gold("dim_branch"), run_ts)
    if name == "agg_branch_performance":
        return aggregates.agg_branch_performance(gold("fact_transactions"), gold("dim_branch"), run_ts)
    if name == "agg_customer_360":
        return aggregates.agg_customer_360(gold("fact_transactions"), run_ts)
    raise ValueError(f"unknown gold table {name!r}")


def build_gold(run: Run, calendar: tuple[date, date] | None = None) -> dict[str, DataFrame]:
    """Dimensions, facts and aggregates stage by stage, each published as a new version.

    A table that fails stops the stages after it; the former versions stay published.
    """
    lake = run.lake
    span = calendar or dims.calendar_span([lake.read("silver", t).select(c) for t, c in DAYS_OF.items()])
    done: dict[str, DataFrame] = {}

    def put(name: str) -> int:
        plan = gold_plan(name, lambda t: silver_of(lake, t), done.__getitem__, lake.spark, run.run_ts, span)
        day = SORTED_BY.get(name)
        done[name], rows = lake.replace(plan.sortWithinPartitions(day) if day else plan, "gold", name)
        return rows

    for stage in STAGES:
        finished = in_parallel({t: lambda t=t: run.step("gold", t, lambda: put(t)) for t in stage})
        if not all(finished.values()):
            raise RuntimeError(f"gold tables failed: {', '.join(t for t, ok in finished.items() if not ok)}")
    return done


def run_nightly(
    lake: Lake,
    sources: Mapping[str, DataFrame],
    run_date: str,
    calendar: tuple[date, date] | None = None,
    halt_on_critical: bool = True,
    strict: bool = False,
) -> dict[str, DataFrame]:
    """One run over all sources; the run log is written even if a step fails.

    ``strict`` refines parents before children and checks foreign keys and formats too.

    Returns the gold tables. Sources are refined side by side. If one fails, or breaks a critical rule
    (``halt_on_critical``), the others are still refined, but no gold is built: :class:`RunStopped`, and the
    tables published by former runs stay as they are.
    """
    run_ts = datetime.combine(parse_run_date(run_date), datetime.min.time())
    run = Run(lake, run_ts, uuid.uuid4().hex, [])

    def load(table: str, source: DataFrame) -> bool:
        done = run.step("bronze", table, lambda: ingest(run, table, source))
        return done and run.step("silver", table, lambda: refine(run, table, halt_on_critical, strict))

    def warehouse() -> int:
        loaded = load_all(lake, gold).filter("status <> 'SKIP'").collect()  # a row per table
        for r in loaded:
            status = {"LOADED": "SUCCESS", "FAIL": "FAILED"}.get(r.status, r.status)
            run.log.append((run.batch_id, run_ts, "warehouse", r.table_name, status, r.rows, 0.0, None))
        if bad := sorted(r.table_name for r in loaded if r.status == "FAIL"):
            raise RuntimeError(f"not loaded: {', '.join(bad)}")
        return sum(r.rows for r in loaded)

    try:
        refined = in_levels(sources, load, strict)
        if bad := sorted(t for t, ok in refined.items() if not ok):
            raise RunStopped(f"sources failed: {', '.join(bad)}")
        gold = build_gold(run, calendar)
        if not run.step("warehouse", "load", warehouse):
            raise RunStopped(f"gold is published, but the warehouse is not loaded: {run.log[-1][7]}")
    finally:
        append_run_log(lake, run.log)
    return gold

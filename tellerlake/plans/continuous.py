"""The incremental night: pull by mark, check, merge, and extend gold instead of building it again."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.plans import dims
from tellerlake.plans.incremental import LOOKBACK, merge_batch, pull, read_merged, remember
from tellerlake.plans.maintain import Keeper, keep_gold
from tellerlake.plans.nightly import DAYS_OF, Run, RunStopped, batch_of, in_levels, parse_run_date
from tellerlake.plans.silver import SPEC, build_silver, parents_of, strict_rules
from tellerlake.quality.engine import dq_gate, enforce_gate, row_results
from tellerlake.session import settle_keys
from tellerlake.sources.lake import Lake
from tellerlake.sources.landing import AUDIT_RELATIONAL, add_audit_columns
from tellerlake.sources.state import append_run_log, update_watermark


def load_part(run: Run) -> str:
    """A load owns one part of bronze, silver and quarantine."""
    return f"{run.run_ts.date().isoformat()}~{run.batch_id}"


def load_source(run: Run, table: str, source: DataFrame, lookback: timedelta, halt: bool, strict: bool = False) -> int:
    """One load of a source: bronze, quarantine, silver, merged state, and the mark last. Returns the rows that passed.

    A load that stops on the way has not moved the mark, so the next one pulls its rows again.
    """
    lake, mine = run.lake, load_part(run)
    bronze = lake.parts("bronze", table)
    # Bronze holds the very rows that were pulled, unless an audit column took the place of one of theirs.
    clash = set(source.columns) & set(AUDIT_RELATIONAL)
    pulled = pull(lake, table, source, lookback, write=bool(clash))
    entry = bronze.replace(add_audit_columns(pulled, batch_of(run, table)), mine, {mine})
    pulled = pulled if clash else bronze.read({mine}, entry).select(*source.columns)
    checks = {"rules": strict_rules(table), "parents": {p: read_merged(lake, p) for p in parents_of(table)}} if strict else {}
    result = build_silver(bronze.read({mine}), SPEC[table], run.run_ts, once=True, **checks)
    outcomes = settle_keys(result.outcomes)
    lake.log(outcomes.withColumn("batch_id", F.lit(run.batch_id)), "dq_results", "json")
    lake.parts("quarantine", table).replace(result.quarantine, mine, {mine})
    if halt:
        enforce_gate(dq_gate(row_results(outcomes), outcomes))
    silver = lake.parts("silver", table)
    entry = silver.replace(result.silver, mine, {mine})
    passed = silver.read({mine}, entry)
    merge_batch(lake, table, passed, pulled)
    update_watermark(lake, table, passed, run.batch_id, run.run_ts, pulled=pulled)
    remember(lake, table, pulled, passed, source.columns, lookback)
    return sum(rows for part, _, rows in entry.folders if part == mine)


def days_of(run: Run) -> tuple[date, date]:
    """The calendar so far, widened by the days of this load."""
    lake, mine = run.lake, load_part(run)
    days = [lake.parts("silver", t).read({mine}).select(c) for t, c in DAYS_OF.items()]
    if lake.current_path("gold", "dim_date"):
        known = lake.current("gold", "dim_date").agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))
        days += [known.select("lo"), known.select("hi")]
    return dims.calendar_span(days)


def run_incremental_night(
    lake: Lake,
    sources: Mapping[str, DataFrame],
    run_date: str,
    calendar: tuple[date, date] | None = None,
    halt_on_critical: bool = True,
    lookback: timedelta = LOOKBACK,
    grain: str = "day",
    buckets: int = 64,
    strict: bool = False,
) -> dict[str, DataFrame]:
    """One night that reads and writes what the night brings and what that touches. Returns the gold tables.

    Sources are pulled from their marks; rows already loaded drop out. If one fails, the others are
    loaded, but gold stays as it is (:class:`RunStopped`) and catches up with the next run. ``strict`` checks foreign keys, against the merged state of the parents, and formats too. ``buckets`` size the parts: about a day of facts, and a keyed table over ``buckets``, should fit a task or a few.
    """
    run = Run(lake, datetime.combine(parse_run_date(run_date), datetime.min.time()), uuid.uuid4().hex, [])
    gold: dict[str, DataFrame] = {}

    def extend() -> int:
        gold.update(keep_gold(Keeper(lake, run.run_ts, grain, buckets), calendar or days_of(run)))
        return lake.parts("gold", "fact_transactions").entry().rows

    try:
        loaded = in_levels(sources, lambda t, s: run.step("load", t, lambda: load_source(run, t, s, lookback, halt_on_critical, strict)), strict)
        if bad := sorted(t for t, ok in loaded.items() if not ok):
            raise RunStopped(f"sources failed: {', '.join(bad)}")
        if not run.step("gold", "extend", extend):
            raise RunStopped(f"gold not extended: {run.log[-1][7]}")
    finally:
        append_run_log(lake, run.log)
    return gold

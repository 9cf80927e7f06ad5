"""Quarantined rows that were corrected: back through the checks, into silver, and marked in quarantine."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.operators.skew import keyed_join, with_keys
from tellerlake.plans.incremental import merge_batch
from tellerlake.plans.nightly import Run
from tellerlake.plans.silver import SPEC, build_silver
from tellerlake.session import settle
from tellerlake.sources.parts import NO_PART, PartTable
from tellerlake.sources.state import LOAD_POLICY

REPROCESSED = "REPROCESSED"


def open_parts(table: PartTable) -> dict[str, DataFrame]:
    """Parts of quarantine with rows that still wait."""
    entry = table.entry()
    waiting = table.read(entry=entry).filter("dq_status = 'FAILED'").select(F.col("_metadata.file_path").alias("file")).distinct()
    folders = {part: folder for part, folder, _ in entry.folders}
    files = [r.file for r in waiting.collect()]  # as many as quarantine has files
    return {part: table.read({part}, entry) for part in sorted(folders) if any(f"/{folders[part]}/" in f for f in files)}


def reprocess_quarantine(run: Run, table: str, fix: Callable[[DataFrame], DataFrame], merged: bool = False) -> int:
    """Apply ``fix`` to the bronze rows behind the waiting rows of quarantine and load what passes now; returns how many rows did.

    Quarantine holds masked data, so the raw values come from bronze, by the key and the load of the row; rows without a key
    cannot be told apart there and stay. What passes goes to a part of silver of its own, from where the next
    night extends gold, and into the merged state if ``merged``. Its rows in quarantine stay, marked with
    the time. What fails again waits on. A repeated call finds nothing to do.
    """
    lake, spec = run.lake, SPEC[table]
    pk = list(LOAD_POLICY[table][2])
    identity = [*pk, "batch_id"]
    quarantine, silver = lake.parts("quarantine", table), lake.parts("silver", table)
    parts = open_parts(quarantine)
    if not parts:
        return 0
    keyed = reduce(Column.__and__, [F.col(c).isNotNull() for c in identity])
    waiting = reduce(DataFrame.unionByName, parts.values()).filter("dq_status = 'FAILED'").filter(keyed)
    keys = settle(waiting.select(*identity).distinct(), "waiting")
    bronze = with_keys(lake.read("bronze", table), keys, identity)
    result = build_silver(fix(bronze), spec, run.run_ts, once=True)
    mine = f"{run.run_ts.date().isoformat()}~{run.batch_id}~fixed"
    entry = silver.replace(result.silver, mine, {mine})
    passed = silver.read({mine}, entry)
    if merged:
        merge_batch(lake, table, passed)
    done = settle(passed.select(*identity).distinct().withColumn("_fixed", F.lit(True)), "fixed")
    marked = []
    for part, rows in parts.items():
        found = keyed_join(rows, done, identity, spread=False)
        fixed = F.coalesce("_fixed", F.lit(False)) & (F.col("dq_status") == "FAILED")
        before = F.col("reprocess_ts") if "reprocess_ts" in rows.columns else F.lit(None).cast("timestamp")
        marked.append(found.withColumns({
            "reprocess_ts": F.when(fixed, F.lit(run.run_ts).cast("timestamp")).otherwise(before),
            "dq_status": F.when(fixed, REPROCESSED).otherwise(F.col("dq_status")),
        }).select(*rows.columns, *([] if "reprocess_ts" in rows.columns else ["reprocess_ts"])).withColumn("_of", F.lit(part)))
    every = settle(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked), "marked")
    quarantine.replace(every.drop("_of"), _part_of(every), parts)
    return sum(n for part, _, n in entry.folders if part == mine)


def _part_of(rows: DataFrame) -> Column:
    """Quarantine parts are loads: a day, or a day and a batch."""
    names = {r[0] for r in rows.select("_of").distinct().collect()}
    by_batch = any("~" in n for n in names)
    day = F.coalesce(F.col("load_date").cast("string"), F.lit(NO_PART))
    return F.concat_ws("~", day, "batch_id") if by_batch else day

"""Incremental loads per source: pull beyond the mark, check, merge by policy, move the mark."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.hashing import row_hash
from tellerlake.operators.merge import dedupe, merged_first, new_rows, union_loads, upsert
from tellerlake.operators.skew import with_keys, without_keys
from tellerlake.operators.windows import latest
from tellerlake.plans.silver import SPEC, SilverResult, build_silver
from tellerlake.session import settle
from tellerlake.sources.lake import Lake
from tellerlake.sources.parts import bucket, plenty
from tellerlake.sources.state import LOAD_POLICY, high_water, incremental, update_watermark

# How far behind the mark rows may arrive late.
LOOKBACK = timedelta(days=1)
# Hash buckets of a merged table; set when its first load is written and kept from then on.
BUCKETS = 16
APPENDED = ("APPEND_ONLY", "FILE_APPEND")
BY_FILE = ("FILE_APPEND", "INCREMENTAL_FILE")


def merged_name(source: str) -> str:
    return f"{source}_merged"


def read_merged(lake: Lake, source: str) -> DataFrame | None:
    """State of a source after its loads so far, None before the first."""
    table = lake.parts("silver", merged_name(source))
    entry = table.entry()
    return table.read(entry=entry) if entry.version else None


def merge_batch(lake: Lake, source: str, batch: DataFrame, present: DataFrame | None = None, buckets: int = BUCKETS) -> int:
    """Bring a batch into the merged table of its source; returns the rows written, or of merged sources the rows there are.

    ``batch`` is a written frame. ``present`` has the keys of a full snapshot, where they are more than those of the batch (rows in quarantine).

    The table is cut into hash buckets of the key. Only buckets that hold a key of the batch are read
    and written again; append-only sources get files beside those they have. A full snapshot
    concerns every bucket, because it may end rows in any of them.
    """
    load_type, column, key = LOAD_POLICY[source]
    pk = list(key)
    table = lake.parts("silver", merged_name(source))
    entry = table.entry()
    notes = {"buckets": entry.notes.get("buckets", buckets)}
    part = bucket(pk, notes["buckets"])
    touched = {r[0] for r in batch.select(part.alias("part")).distinct().collect()}  # at most one name a bucket
    if load_type == "FULL_MERGE":
        touched |= entry.parts
    target = table.read(touched, entry) if entry.version else lake.spark.createDataFrame([], batch.schema)
    if load_type in APPENDED:
        placed = plenty(lake.spark, batch.count(), notes["buckets"])
        return table.append(new_rows(target, batch, pk, [column]), part, notes, placed).rows - entry.rows
    order = [column] if column else pk
    if load_type == "FULL_MERGE" and entry.version:
        # A full snapshot replaces known rows; keys it no longer has stay, marked inactive.
        stay = without_keys(target, batch, pk)
        held = with_keys(stay, present, pk) if present is not None else stay.limit(0)
        gone = without_keys(stay, present, pk) if present is not None else stay
        parts = [held, gone.withColumn("is_active", F.lit(0)), latest(batch, pk, pk).withColumn("is_active", F.lit(1))]
        merged = union_loads(parts)
    else:
        merged = upsert(target, batch, pk, order) if entry.version else merged_first(batch, pk, order)
        if load_type == "FULL_MERGE":
            merged = merged.withColumn("is_active", F.lit(1))
    return table.replace(merged, part, touched, notes).rows


def seen_of(lake: Lake, source: str) -> DataFrame | None:
    """Fingerprints of the rows of the last window that are merged already."""
    table = lake.parts("metadata", f"seen_{source}")
    entry = table.entry()
    return table.read(entry=entry) if entry.version else None


def pull(lake: Lake, source: str, df: DataFrame, lookback: timedelta = LOOKBACK, write: bool = True) -> DataFrame:
    """What a load has to look at, written once so that the rows merged and the mark are the same rows even if the source moves on.

    Relational sources are pulled from the mark on, less ``lookback``; rows of that window that former loads have
    merged as they are drop out by their fingerprints. Of file sources every given row counts, since files may
    bring older rows. Without ``write`` the caller writes them.
    """
    load_type, column, key = LOAD_POLICY[source]
    pk = list(key)
    by_file = load_type in BY_FILE
    new = df if by_file or not column else incremental(df, column, high_water(lake, source), lookback)
    seen = None if by_file or not column else seen_of(lake, source)
    if seen is not None:
        marked = new.withColumn("_seen", row_hash(*sorted(df.columns)))
        new = without_keys(marked, seen.withColumnRenamed("seen", "_seen"), ["_seen"]).drop("_seen")
    once = dedupe(new, pk, [column] if column else pk)
    return settle(once, "pulled") if write else once


def remember(lake: Lake, source: str, pulled: DataFrame, passed: DataFrame, columns: list[str], lookback: timedelta) -> None:
    """Keep the fingerprints of the passed rows that the next load will meet again, and move on from those it will not."""
    load_type, column, key = LOAD_POLICY[source]
    if load_type in BY_FILE or not column:
        return
    mark = high_water(lake, source)
    window = incremental(pulled, column, mark, lookback)
    rows = with_keys(window, incremental(passed, column, mark, lookback), list(key)).select(F.col(column).cast("timestamp").alias("at"), row_hash(*sorted(columns)).alias("seen"))
    before = seen_of(lake, source)
    if before is not None:
        rows = incremental(before, "at", mark, lookback).unionByName(rows).distinct()
    lake.parts("metadata", f"seen_{source}").replace(rows, "window", {"window"})


def incremental_run(
    lake: Lake, source: str, df: DataFrame, batch_id: str, run_ts: datetime, lookback: timedelta = LOOKBACK
) -> int:
    """One load of a source; a repeated run changes nothing. Returns the rows written to the merged table.

    Rows go through the checks and masks of silver: those that fail go to quarantine and leave the row
    known before in place. The mark follows the rows that passed.
    """
    pulled = pull(lake, source, df, lookback)
    checked = build_silver(pulled, SPEC[source], run_ts)
    quarantine(lake, merged_name(source), checked, batch_id)
    silver = settle(checked.silver, "silver-batch")
    rows = merge_batch(lake, source, silver, pulled)
    update_watermark(lake, source, silver, batch_id, run_ts, pulled=pulled)
    remember(lake, source, pulled, silver, df.columns, lookback)
    return rows


def quarantine(lake: Lake, table: str, checked: SilverResult, batch_id: str) -> None:
    """Failed rows of a load in place of those that an earlier attempt of the same load left."""
    failed = checked.quarantine.withColumn("batch_id", F.lit(batch_id))
    lake.parts("quarantine", table).replace(failed, batch_id, {batch_id})

"""Run state: watermarks and the run log."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.operators.windows import latest
from tellerlake.sources.lake import Lake

EPOCH = datetime(1900, 1, 1)

# Load type, watermark column and merge key of every source.
LOAD_POLICY = {
    "branches": ("FULL_MERGE", None, ("branch_code",)),
    "customers": ("INCREMENTAL_MERGE", "updated_at", ("customer_id",)),
    "accounts": ("INCREMENTAL_MERGE", "updated_at", ("account_id",)),
    "transactions": ("APPEND_ONLY", "txn_timestamp", ("txn_id",)),
    "payment_gateway_logs": ("FILE_APPEND", "processed_timestamp", ("txn_id",)),
    "credit_bureau_reports": ("INCREMENTAL_FILE", "bureau_pull_date", ("customer_id", "bureau_pull_date")),
}

WATERMARK_SCHEMA = """source string, high_water timestamp, run_ts timestamp, status string, load_type string,
    watermark_column string, rows_last_loaded bigint, last_batch_id string"""
RUN_LOG_SCHEMA = """batch_id string, run_ts timestamp, phase string, step string, status string,
    rows bigint, duration_s double, error string, started_at timestamp"""


def _initial(lake: Lake) -> DataFrame:
    rows = [
        (source, EPOCH, EPOCH, "NEVER_RUN", load_type, column, 0, None)
        for source, (load_type, column, _) in LOAD_POLICY.items()
    ]
    return lake.spark.createDataFrame(rows, WATERMARK_SCHEMA)


def read_watermarks(lake: Lake) -> DataFrame:
    """Latest state of every source. Each run appends a row; there is one row per source and run."""
    states = _initial(lake).unionByName(lake.read_log("watermarks", WATERMARK_SCHEMA))
    return latest(states, ["source"], ["run_ts"])


def update_watermark(
    lake: Lake, source: str, loaded: DataFrame, batch_id: str, run_ts: datetime, status: str = "SUCCESS", pulled: DataFrame | None = None
) -> None:
    """Record a run: how far the loaded rows reach, keeping load type and column of the source.

    ``loaded`` are the rows that passed their checks. A row with a time after the run does not move the mark beyond
    the run: it would hide all that the source brings until then. A load without rows keeps the former mark.
    ``pulled`` are all rows the load looked at, for their number.
    """
    load_type, column, _ = LOAD_POLICY[source]
    before = high_water(lake, source)
    reached = F.col(column).cast("timestamp") if column else F.lit(None).cast("timestamp")
    reach = F.max(F.when(reached <= F.lit(run_ts).cast("timestamp"), reached))
    state = loaded.agg(
        F.lit(source).alias("source"),
        F.greatest(reach, F.lit(before).cast("timestamp")).alias("high_water"),
        F.lit(run_ts).cast("timestamp").alias("run_ts"),
        F.lit(status).alias("status"),
        F.lit(load_type).alias("load_type"),
        F.lit(column).cast("string").alias("watermark_column"),
        F.lit(pulled.count()).cast("bigint").alias("rows_last_loaded") if pulled is not None else F.count(F.lit(1)).alias("rows_last_loaded"),
        F.lit(batch_id).alias("last_batch_id"),
    )
    lake.log(state, "watermarks")


def high_water(lake: Lake, source: str) -> datetime:
    row = read_watermarks(lake).filter(F.col("source") == source).select("high_water").first()
    if row is None:
        raise LookupError(f"unknown source {source!r}")
    return row.high_water


def incremental(df: DataFrame, column: str | None, mark: datetime, lookback: timedelta = timedelta(0)) -> DataFrame:
    """Rows from the high-water mark on; everything for a source without a watermark column.

    Rows at the very time of the mark and rows without a time are read again by every load, and
    ``lookback`` reads rows again that may have arrived late; keyed merges make that harmless.
    """
    if column is None:
        return df
    floor = max(mark - lookback, EPOCH)
    literal = F.lit(floor).cast(df.schema[column].dataType)
    return df.filter((F.col(column) >= literal) | F.col(column).isNull())


def watermark_report(lake: Lake) -> DataFrame:
    return read_watermarks(lake).select(
        "source", "status", "load_type", "watermark_column", "high_water", "rows_last_loaded"
    )


def append_run_log(lake: Lake, rows: list[tuple]) -> None:
    """Add steps of a run; the error text and the time a step started at may be left out."""
    rows = [(*r, *[None] * (9 - len(r))) for r in rows]
    lake.log(lake.spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1), "run_log")


def read_run_log(lake: Lake) -> DataFrame:
    return lake.read_log("run_log", RUN_LOG_SCHEMA)


def run_status(run_log: DataFrame) -> DataFrame:
    """Status of every run: SUCCESS if all steps were, FAILED if none was, else PARTIAL."""
    ok = F.count_if(F.col("status") == "SUCCESS")
    steps = F.count(F.lit(1))
    status = F.when(ok == steps, "SUCCESS").when(ok == 0, "FAILED").otherwise("PARTIAL")
    return run_log.groupBy("batch_id").agg(
        F.min("run_ts").alias("run_ts"),
        status.alias("status"),
        steps.alias("steps"),
        F.sum("rows").alias("total_rows"),
        F.round(F.sum("duration_s"), 3).alias("duration_s"),
    )

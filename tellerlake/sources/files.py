"""Landing files by ledger: every file is loaded once, whenever it arrives and whatever times its rows have."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.functions.casting import enforce_types
from tellerlake.operators.skew import keyed_join
from tellerlake.session import settle, settle_keys
from tellerlake.sources.lake import Lake
from tellerlake.sources.landing import CORRUPT, Batch, add_audit_columns, read_landing_csv

FILE_KEY = ["file_name", "size", "modified"]
LEDGER_SCHEMA = """source string, file_name string, size bigint, modified timestamp, rows bigint, corrupt_rows bigint,
    status string, batch_id string, loaded_at timestamp"""


def listing(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """Files of a folder and its subfolders (path, name, size, time), from the listing alone; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("file_name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def ledger(lake: Lake, source: str) -> DataFrame:
    """Files of a source that were loaded so far."""
    table = lake.parts("metadata", f"files_{source}")
    entry = table.entry()
    return table.read(entry=entry) if entry.version else lake.spark.createDataFrame([], LEDGER_SCHEMA)


def new_files(lake: Lake, source: str, path: str, pattern: str = "*.csv") -> DataFrame:
    """Files that the ledger does not have. A file of a known name with another size or time is another file."""
    return listing(lake.spark, path, pattern).join(ledger(lake, source).select(*FILE_KEY), FILE_KEY, "left_anti")


def load_files(lake: Lake, source: str, path: str, types: dict[str, str], batch_id: str, run_ts: datetime, pattern: str = "*.csv", header: bool = True) -> int:
    """Load the new files of a source into bronze; returns their number.

    Lines with too many or too few fields go to quarantine as they are, all others are typed. The ledger gets its rows
    last: a load that stops before is repeated as a whole, with the same part of bronze.
    """
    spark, columns = lake.spark, list(types)
    fresh = settle(new_files(lake, source, path, pattern), "new-files")
    paths = [r.path for r in fresh.select("path").collect()]  # Spark's reader takes a list; as long as the files of one load
    if not paths:
        return 0
    text = settle(read_landing_csv(spark, paths, columns, pattern, header=header, corrupt=True), "landing")
    good = enforce_types(text.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), types)
    batch = Batch(batch_id, run_ts, src_system=f"{source}_csv")
    lake.parts("bronze", source).replace(add_audit_columns(good, batch), batch_id, {batch_id})
    bad = text.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("line"), "src_file_name", F.lit("MALFORMED_LINE").alias("quarantine_reason"), F.lit(batch_id).alias("batch_id"), F.lit(run_ts).cast("timestamp").alias("quarantine_ts"),
    )
    lake.parts("quarantine", f"{source}_lines").replace(bad, batch_id, {batch_id})
    counts = text.groupBy(F.col("src_file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("lines"), F.count(CORRUPT).alias("corrupt"))
    counted = keyed_join(fresh, settle_keys(counts), ["file_name"], spread=False)
    entry = counted.select(
        F.lit(source).alias("source"), *FILE_KEY, (F.coalesce("lines", F.lit(0)) - F.coalesce("corrupt", F.lit(0))).cast("bigint").alias("rows"),
        F.coalesce("corrupt", F.lit(0)).cast("bigint").alias("corrupt_rows"), F.when(F.col("corrupt") > 0, "PARTIAL").otherwise("LOADED").alias("status"),
        F.lit(batch_id).alias("batch_id"), F.lit(run_ts).cast("timestamp").alias("loaded_at"),
    )
    lake.parts("metadata", f"files_{source}").replace(entry, batch_id, {batch_id})
    return len(paths)


def batch_manifest(lake: Lake, sources: list[str]) -> DataFrame:
    """Per load: files, rows, lines put aside, and the latest file."""
    every = lake.spark.createDataFrame([], LEDGER_SCHEMA)
    for source in sources:
        every = every.unionByName(ledger(lake, source))
    return every.groupBy("source", "batch_id").agg(
        F.count(F.lit(1)).alias("files_processed"), F.sum("rows").alias("rows"), F.sum("corrupt_rows").alias("corrupt_rows"),
        F.when(F.count_if(F.col("status") != "LOADED") > 0, "PARTIAL").otherwise("LOADED").alias("status"), F.max("modified").alias("last_modified"),
    )

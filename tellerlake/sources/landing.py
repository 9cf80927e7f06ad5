"""Landing files and relational sources."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.functions.hashing import row_hash

# File name patterns of the landing sources.
LANDING_PATTERNS = {
    "payment_gateway_logs": "payment_gateway_logs_*.csv",
    "credit_bureau_reports": "credit_bureau_reports_*.csv",
}


def landing_ddl(columns: list[str]) -> str:
    return ", ".join(f"{c} string" for c in columns)


# A line that does not have the fields of the contract, as it stands in the file.
CORRUPT = "corrupt_line"


def read_landing_csv(
    spark: SparkSession, path: str | list[str], columns: list[str], pattern: str = "*.csv", header: bool = True, corrupt: bool = False
) -> DataFrame:
    """CSV files, every column as text, and the name of the file of each row.

    With ``corrupt``, a line with more or fewer fields than the contract comes whole in :data:`CORRUPT`, which is NULL for
    all others; without, surplus fields are cut and missing ones are NULL. Fields are counted for every line, whatever
    columns a query picks.
    """
    reader = spark.read.option("header", str(header).lower()).option("enforceSchema", "false").option("pathGlobFilter", pattern)
    shape, extra = landing_ddl(columns), []
    if corrupt:
        shape, extra = f"{shape}, {CORRUPT} string", [CORRUPT]
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false")
    return reader.schema(shape).csv(path).select(*columns, *extra, F.col("_metadata.file_name").alias("src_file_name"))


@dataclass(frozen=True)
class RelationalTable:
    """A source table behind JDBC, or its Parquet extract if ``path`` is set."""

    name: str
    columns: tuple[str, ...]
    key: str
    path: str | None = None
    url: str | None = None
    lower: int = 0
    upper: int = 0
    partitions: int = 1


def jdbc_options(table: RelationalTable) -> dict[str, str]:
    """Reader options: only the listed columns, read in parallel by key range."""
    if not table.url:
        raise ValueError(f"{table.name} has neither a path nor a JDBC url")
    options = {
        "url": table.url,
        "query" if table.partitions == 1 else "dbtable": f"SELECT {', '.join(table.columns)} FROM {table.name}",
        "fetchsize": "10000",
    }
    if table.partitions > 1:
        options["dbtable"] = f"({options['dbtable']}) src"
        options |= {
            "partitionColumn": table.key,
            "lowerBound": str(table.lower),
            "upperBound": str(table.upper),
            "numPartitions": str(table.partitions),
        }
    return options


def read_relational(spark: SparkSession, table: RelationalTable, properties: dict[str, str] | None = None) -> DataFrame:
    """Listed columns of a source table. Rows are not ordered; order is for presentation."""
    if table.path:
        return spark.read.parquet(table.path).select(*table.columns)
    return spark.read.format("jdbc").options(**jdbc_options(table), **(properties or {})).load()


@dataclass(frozen=True)
class Batch:
    """What a run knows about itself; the same for all rows it loads."""

    batch_id: str
    run_ts: datetime
    src_system: str
    src_table: str | None = None
    load_type: str | None = None
    src_file_name: str | None = None


AUDIT = [
    "src_system", "src_file_name", "load_timestamp", "load_date",
    "batch_id", "row_hash", "is_active", "pipeline_phase",
]
AUDIT_RELATIONAL = [*AUDIT, "src_table", "load_type"]


def add_audit_columns(df: DataFrame, batch: Batch) -> DataFrame:
    """Fingerprint of the source columns plus 7 audit columns, or 9 for relational sources."""
    source = [c for c in df.columns if c != "src_file_name"]
    file_name = F.col("src_file_name") if "src_file_name" in df.columns else F.lit(batch.src_file_name or batch.src_table)
    run_ts = F.lit(batch.run_ts).cast("timestamp")
    audit = {
        "src_system": F.lit(batch.src_system),
        "src_file_name": file_name,
        "load_timestamp": run_ts,
        "load_date": run_ts.cast("date"),
        "batch_id": F.lit(batch.batch_id),
        "row_hash": row_hash(*source),
        "is_active": F.lit(1),
        "pipeline_phase": F.lit("bronze"),
    }
    if batch.src_table:
        audit |= {"src_table": F.lit(batch.src_table), "load_type": F.lit(batch.load_type)}
    return df.select(*source, *[c.alias(name) for name, c in audit.items()])

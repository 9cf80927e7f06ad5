"""Zones of the lake as folders of Parquet files."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tellerlake.sources.parts import PartTable, children, remove

ZONES = ("landing", "bronze", "silver", "quarantine", "gold", "warehouse", "metadata")
# The published version of a table, its rows and when it was published.
_VERSION_SCHEMA = "zone string, table_name string, version string, rows bigint, committed_at timestamp"


class RowCountMismatch(RuntimeError):
    """What was read back differs from what was written."""


class EmptySource(RuntimeError):
    """A source delivered no rows."""


@dataclass(frozen=True)
class Lake:
    """Tables under one base folder.

    Loads of bronze, silver and quarantine, and all that is maintained from night to night, are tables of parts (:meth:`parts`):
    a load owns its part, and what it does not touch stays as it is. Gold and warehouse tables that are replaced as a
    whole are written to a folder of their own and published by one appended log row, so readers never see a
    half-written or missing table. Metadata tables grow by folders.
    """

    spark: SparkSession
    base: str

    def path(self, zone: str, table: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"unknown zone {zone!r}")
        return f"{self.base.rstrip('/')}/{zone}/{table}"

    def parts(self, zone: str, table: str) -> PartTable:
        return PartTable(self.spark, self.path(zone, table))

    def read(self, zone: str, table: str, schema: str | None = None) -> DataFrame:
        """All rows of a table of parts, or all Parquet files of another one with the partition columns from the folder names."""
        entry = self.parts(zone, table).entry()
        if entry.version:
            return self.parts(zone, table).read(entry=entry)
        reader = self.spark.read.option("pathGlobFilter", "*.parquet")
        if schema:
            reader = reader.schema(schema)
        return reader.parquet(self.path(zone, table))

    def append(self, df: DataFrame, zone: str, table: str, partition_by: list[str] | None = None) -> str:
        path = self.path(zone, table)
        df.write.mode("append").option("compression", "zstd").partitionBy(*(partition_by or [])).parquet(path)
        return path

    def overwrite(self, df: DataFrame, zone: str, table: str, partition_by: list[str] | None = None) -> str:
        """Replace the partitions present in ``df``, or the table if it has none.

        A repeated run of the same load date replaces its own output.
        """
        path = self.path(zone, table)
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
        writer.parquet(path)
        return path

    def log(self, df: DataFrame, table: str, kind: str = "parquet") -> None:
        """Add rows to a metadata table. Every call writes a folder of its own: steps that run side
        by side would otherwise share the temporary folder of the committer."""
        df.write.format(kind).save(f"{self.path('metadata', table)}/entry={uuid.uuid4().hex}")

    def read_log(self, table: str, schema: str, kind: str = "parquet") -> DataFrame:
        """All rows of a metadata table, none before the first entry."""
        reader = self.spark.read.format(kind).schema(schema).option("recursiveFileLookup", "true")
        try:
            return reader.load(self.path("metadata", table))
        except Exception as missing:  # the analyzer reports an absent folder this way
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return self.spark.createDataFrame([], schema)

    def write_version(self, df: DataFrame, zone: str, table: str) -> tuple[str, int]:
        """Write a new unpublished version; returns its name and its rows as read back."""
        version = uuid.uuid4().hex
        path = f"{self.path(zone, table)}/version={version}"
        df.write.option("compression", "zstd").parquet(path)
        return version, self.spark.read.parquet(path).count()

    def publish(self, zone: str, table: str, version: str, rows: int) -> None:
        row = self.spark.createDataFrame(
            [(zone, table, version, rows)], "zone string, table_name string, version string, rows bigint"
        ).withColumn("committed_at", F.current_timestamp())
        self.log(row.coalesce(1), "versions")

    def replace(self, df: DataFrame, zone: str, table: str) -> tuple[DataFrame, int]:
        """Write and publish a new version; returns the table and its rows."""
        version, rows = self.write_version(df, zone, table)
        self.publish(zone, table, version, rows)
        return self.spark.read.parquet(f"{self.path(zone, table)}/version={version}"), rows

    def vacuum(self, zone: str, table: str, keep: int = 2) -> int:
        """Remove what the newest ``keep`` versions of a table do not need; returns how many folders went.

        Unpublished versions go too, so no other run may be writing the table meanwhile.
        """
        parts = self.parts(zone, table)
        gone = parts.vacuum(keep)
        rows = self.versions().filter((F.col("zone") == zone) & (F.col("table_name") == table))
        held = {f"version={r.version}" for r in rows.orderBy(F.desc("committed_at")).limit(keep).collect()}
        for name in children(self.spark, self.path(zone, table)):
            if held and name.startswith("version=") and name not in held:
                remove(self.spark, f"{self.path(zone, table)}/{name}")
                gone += 1
        return gone

    def versions(self) -> DataFrame:
        """Log of published versions."""
        return self.read_log("versions", _VERSION_SCHEMA)

    def current_path(self, zone: str, table: str) -> str | None:
        last = (
            self.versions()
            .filter((F.col("zone") == zone) & (F.col("table_name") == table))
            .agg(F.max_by("version", "committed_at"))
            .first()[0]
        )
        return f"{self.path(zone, table)}/version={last}" if last else None

    def current(self, zone: str, table: str) -> DataFrame:
        entry = self.parts(zone, table).entry()
        if entry.version:
            return self.parts(zone, table).read(entry=entry)
        path = self.current_path(zone, table)
        if path is None:
            raise LookupError(f"{zone}.{table} has no published version")
        return self.spark.read.parquet(path)


def write_verified(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write and compare the rows read back with the rows that went in.

    The incoming rows are counted by the write itself.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    written = seen.get["rows"]
    found = df.sparkSession.read.parquet(path).count()
    if found != written:
        raise RowCountMismatch(f"{path}: wrote {written} rows, found {found}")
    return found


def require_rows(df: DataFrame, name: str, min_rows: int = 1) -> str:
    """Raise on an empty source; say LOW if it has fewer rows than expected, else OK."""
    found = df.limit(min_rows).count()
    if found == 0:
        raise EmptySource(f"{name} delivered no rows")
    return "OK" if found >= min_rows else "LOW"


def zone_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Data files and bytes per zone and table, from the file listing alone."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select("path", "length")
    )
    inside = F.regexp_extract("path", "/(landing|bronze|silver|quarantine|gold|warehouse|metadata)/([^/]+)/", 1)
    table = F.regexp_extract("path", "/(landing|bronze|silver|quarantine|gold|warehouse|metadata)/([^/]+)/", 2)
    listed = files.select(inside.alias("zone"), table.alias("table_name"), "path", "length")
    data = listed.filter((F.col("zone") != "") & ~F.col("path").rlike("/[_.][^/]*$"))
    return data.groupBy("zone", "table_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def register_zone(lake: Lake, zone: str, tables: list[str], prefix: str) -> list[str]:
    """Register published tables as temporary views ``<prefix><table>``; a new run replaces them."""
    names = []
    for table in tables:
        if lake.current_path(zone, table) is None:
            continue
        name = f"{prefix}{table}"
        lake.current(zone, table).createOrReplaceTempView(name)
        names.append(name)
    return names


def register_external(lake: Lake, zone: str, tables: list[str], prefix: str) -> list[str]:
    """Register published tables in the session catalog, at the folder of their newest version."""
    names = []
    for table in tables:
        path = lake.current_path(zone, table)
        if path is None:
            continue
        name = f"{prefix}{table}"
        lake.spark.sql(f"DROP TABLE IF EXISTS {name}")
        lake.spark.catalog.createTable(name, path=path, source="parquet")
        names.append(name)
    return names

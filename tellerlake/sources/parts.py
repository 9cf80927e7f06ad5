"""Tables of named parts, changed part by part.

A part is a day, a month, a load or a hash bucket of a key: a folder that Spark wrote, or several of them.
A version of the table is one small entry that lists its folders. A change writes new folders for the parts
it touches and a new entry; all other folders are listed again and are neither read nor copied.
Readers of an older entry keep their folders until :meth:`PartTable.vacuum`.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "_part"
NO_PART = "none"
# A task that has so many rows for each part writes its own file of the part; fewer are first brought together.
FILE_ROWS = 10_000


class VersionTaken(RuntimeError):
    """Another run has published the version that this one meant to publish."""


def bucket(key: list[str], buckets: int) -> Column:
    """Name of the hash bucket of a key."""
    return F.lpad(F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(buckets)).cast("string"), 6, "0")


def plenty(spark: SparkSession, rows: int, parts: int) -> bool:
    """Whether every task of a load of ``rows`` rows has enough of them for a file of its own in each of ``parts`` parts."""
    return rows >= FILE_ROWS * parts * spark.sparkContext.defaultParallelism


def part_name(*cols: str) -> Column:
    return F.concat_ws("~", *[F.coalesce(F.col(c).cast("string"), F.lit(NO_PART)) for c in cols])


def _folder(spark: SparkSession, path: str):
    """The folder behind a path, in whatever store it lies, and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    folder, store = _folder(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(folder)) if store.exists(folder) else []


def exists(spark: SparkSession, path: str) -> bool:
    folder, store = _folder(spark, path)
    return store.exists(folder)


def read_text(spark: SparkSession, path: str) -> str:
    file, store = _folder(spark, path)
    stream = store.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file that appears whole or not at all; an existing one is not replaced."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    file, store = _folder(spark, draft)
    stream = store.create(file, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if exists(spark, path) or not store.rename(file, spark._jvm.org.apache.hadoop.fs.Path(path)):
        store.delete(file, False)
        raise VersionTaken(path)


def remove(spark: SparkSession, path: str) -> None:
    folder, store = _folder(spark, path)
    store.delete(folder, True)


@dataclass(frozen=True)
class Entry:
    """One version: its folders by part, the columns of the table, and notes such as the highest key."""

    version: int = 0
    folders: tuple[tuple[str, str, int], ...] = ()
    schema: T.StructType | None = None
    notes: Mapping[str, int] = field(default_factory=dict)

    @property
    def parts(self) -> set[str]:
        return {part for part, _, _ in self.folders}

    @property
    def rows(self) -> int:
        return sum(rows for _, _, rows in self.folders)


@dataclass(frozen=True)
class PartTable:
    spark: SparkSession
    path: str

    def published(self) -> list[int]:
        """Versions, from the listing of one folder."""
        found = [re.match(r"v(\d+)\.json$", name) for name in children(self.spark, f"{self.path}/entries")]
        return [int(m.group(1)) for m in found if m]

    def entry(self, version: int | None = None) -> Entry:
        """The newest version, or a given one. An entry names as many folders as the table has days or buckets."""
        known = self.published() if version is None else [version]
        if not known:
            return Entry()
        made = json.loads(read_text(self.spark, f"{self.path}/entries/{_name(known[-1])}"))
        return Entry(known[-1], tuple(tuple(f) for f in made["folders"]), T.StructType.fromJson(made["columns"]), made["notes"])

    def read(self, parts: Iterable[str] | Callable[[str], bool] | None = None, entry: Entry | None = None) -> DataFrame:
        """Rows of the table, or of some of its parts only; the folders of the others are not opened."""
        entry = entry or self.entry()
        if entry.schema is None:
            raise LookupError(f"{self.path} has no published version")
        wanted = parts if callable(parts) or parts is None else set(parts).__contains__
        folders = [f"{self.path}/{folder}" for part, folder, _ in entry.folders if wanted is None or wanted(part)]
        return self.spark.read.schema(entry.schema).parquet(*folders) if folders else self.spark.createDataFrame([], entry.schema)

    def replace(self, df: DataFrame, part: Column | str, owned: Iterable[str] | Callable[[str], bool] = (), notes: Mapping[str, int] | None = None, placed: bool = False) -> Entry:
        """The rows of ``df`` in place of the parts they lie in and of those ``owned``, even if they bring no rows for them.

        ``part`` says in which part a row lies, or names the one in which all do. ``placed`` rows lie in few tasks a part, or are
        so many that each task has its own files of the parts; others are shuffled by part.
        """
        before = self.entry()
        owns = owned if callable(owned) else set(owned).__contains__
        written = self._write(df, part, placed)
        gone = {p for p, _, _ in written}
        kept = [f for f in before.folders if f[0] not in gone and not owns(f[0])]
        return self._publish(before, kept + written, df.schema, notes)

    def append(self, df: DataFrame, part: Column | str, notes: Mapping[str, int] | None = None, placed: bool = False) -> Entry:
        """The rows of ``df`` beside those that their parts have already."""
        before = self.entry()
        return self._publish(before, [*before.folders, *self._write(df, part, placed)], df.schema, notes)

    def _write(self, df: DataFrame, part: Column | str, placed: bool = False) -> list[tuple[str, str, int]]:
        folder = f"data-{uuid.uuid4().hex}"
        path = f"{self.path}/{folder}"
        # Rows of a part meet in a few tasks, so that parts have few files; a large part is split by Spark. Rows of one part need not meet.
        marked = df.withColumn(PART, F.lit(part) if isinstance(part, str) else part)
        gathered = marked if placed or isinstance(part, str) else marked.hint("rebalance", PART)
        gathered.write.option("compression", "zstd").partitionBy(PART).parquet(path)
        names = [n for n in children(self.spark, path) if n.startswith(f"{PART}=")]
        if not names:
            return []
        counts = self.spark.read.schema(f"{PART} string").parquet(path).groupBy(PART).count().collect()
        rows = {r[PART]: r["count"] for r in counts}
        return [(_unescaped(n), f"{folder}/{n}", rows[_unescaped(n)]) for n in names]

    def _publish(self, before: Entry, folders: Iterable[tuple[str, str, int]], schema: T.StructType, notes: Mapping[str, int] | None) -> Entry:
        old = before.schema.fields if before.schema else []
        # Columns that the change does not have stay: their older rows still hold them.
        fields = [*[T.StructField(f.name, f.dataType, True) for f in schema], *[f for f in old if f.name not in schema.names]]
        entry = Entry(before.version + 1, tuple(sorted(folders)), T.StructType(fields), {**before.notes, **(notes or {})})
        made = {"columns": entry.schema.jsonValue(), "notes": dict(entry.notes), "folders": entry.folders}
        create_text(self.spark, f"{self.path}/entries/{_name(entry.version)}", json.dumps(made))
        return entry

    def vacuum(self, keep: int = 2) -> int:
        """Remove entries but the newest ``keep``, and folders that none of those lists; returns how many folders went."""
        known = self.published()
        for version in known[:-keep]:
            remove(self.spark, f"{self.path}/entries/{_name(version)}")
        listed = {folder.split("/")[0] + "/" + folder.split("/")[1] for v in known[-keep:] for _, folder, _ in self.entry(v).folders}
        gone = 0
        for data in children(self.spark, self.path):
            if not data.startswith("data-"):
                continue
            inside = [n for n in children(self.spark, f"{self.path}/{data}") if n.startswith(f"{PART}=")]
            free = [n for n in inside if f"{data}/{n}" not in listed]
            for name in free:
                remove(self.spark, f"{self.path}/{data}/{name}")
            if len(free) == len(inside):
                remove(self.spark, f"{self.path}/{data}")
            gone += len(free)
        return gone


def _name(version: int) -> str:
    return f"v{version:010d}.json"


def _unescaped(folder: str) -> str:
    """Value of a partition folder; Spark writes special characters as %XX."""
    from urllib.parse import unquote

    return unquote(folder.removeprefix(f"{PART}="))

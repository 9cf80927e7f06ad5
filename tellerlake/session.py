"""Session settings shared by every operator."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

# Data read back with a proven size below this may be broadcast (bytes, before compression); unless it is set, at most
# the driver's heap / HEAP_SHARE: a table to look up takes some four times its rows there, and jobs run side by side.
BROADCAST_BYTES = "tellerlake.broadcast.maxBytes"
# A key holding at least this many rows is spread over several tasks.
HOT_ROWS = "tellerlake.skew.hotRows"
# Over how many tasks a hot key is spread.
FANOUT = "tellerlake.skew.fanout"

DEFAULTS = {BROADCAST_BYTES: 64 * 1024 * 1024, HOT_ROWS: 2_000_000, FANOUT: 64}
HEAP_SHARE = 128

_local_dirs: dict[str, str] = {}


def driver_heap(spark: SparkSession) -> int:
    """Bytes that the driver's heap can grow to."""
    return spark._jvm.java.lang.Runtime.getRuntime().maxMemory()


def setting(spark: SparkSession, key: str) -> int:
    found = spark.conf.get(key, "")
    if not found and key == BROADCAST_BYTES:
        return min(DEFAULTS[key], driver_heap(spark) // HEAP_SHARE)
    return int(found or DEFAULTS[key])


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor reaches: ``spark.checkpoint.dir`` of the cluster.

    Only a local master may run without it; then one temporary folder per application is made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="run-tellerlake-")
    return _local_dirs[app]


T = TypeVar("T")


def in_parallel(work: Mapping[str, Callable[[], T]], at_once: int = 8) -> dict[str, T]:
    """Submit independent Spark jobs from several driver threads and wait for all of them.

    Jobs of small tables fill the gaps that the last tasks of large ones leave.
    """
    with ThreadPoolExecutor(max_workers=min(at_once, max(1, len(work)))) as pool:
        futures = {name: pool.submit(job) for name, job in work.items()}
        return {name: f.result() for name, f in futures.items()}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; everything of one application sits in one folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tellerlake-{app}/{name}-{uuid.uuid4().hex[:12]}"


def settle_keys(df: DataFrame) -> DataFrame:
    """Work out a narrow frame (keys, flags, a few totals) once, by a reliable checkpoint."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write a derived table once and read it back: cuts lineage, survives lost executors, and later
    plans read only the columns and row groups they need."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

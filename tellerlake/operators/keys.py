"""Surrogate keys 1..N; 0 stands for the unknown member."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellerlake.functions.hashing import row_hash
from tellerlake.operators.skew import without_keys
from tellerlake.session import BROADCAST_BYTES, setting, settle_keys


# Few enough that hashing spreads a large table's buckets evenly over the tasks.
_ROWS_PER_BUCKET = 20_000
# So many hex digits of a bucket are summed up within a group of buckets, the digits before name the group.
_INNER = 3


def _digits(rows: int) -> int:
    """Hex characters that cut ``rows`` into buckets of at most some 20,000."""
    digits = 1
    while rows > _ROWS_PER_BUCKET * 16**digits:
        digits += 1
    return digits


def _offsets(counts: DataFrame, bucket: str) -> DataFrame:
    """Rows before each bucket. Buckets are summed within groups of 16**3 and the groups among themselves, so that
    no task sees all buckets of a large table."""
    group = F.expr(f"substring({bucket}, 1, greatest(length({bucket}) - {_INNER}, 0))")
    grouped = counts.withColumn("_group", group)
    inner = Window.partitionBy("_group").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(F.lit(0)).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("_group").agg(F.sum("_n").alias("_n")).select("_group", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_before"))
    within = grouped.withColumn("_within", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
    return within.join(groups, "_group").select(bucket, (F.col("_within") + F.col("_before")).alias("_offset"))


def assign_sk(
    df: DataFrame, natural_key: list[str], name: str, start: int = 0, as_type: str = "bigint", digits: int | None = None
) -> DataFrame:
    """Number the rows of a frame with a unique natural key, densely from ``start + 1``.

    Rows are numbered in the order of the MD5 of their key. Its first ``digits`` hex characters cut
    the rows into 16**digits buckets of equal size whatever the keys look like, so every bucket is
    numbered on its own and only the bucket counts are summed up. The numbers do not depend on ``digits``, which
    by default follows from the number of rows, however many. Pass a written table: its keys are read twice,
    once for the counts.
    """
    digits = digits or _digits(df.count())
    digest, bucket = "_digest", "_bucket"
    hashed = row_hash(*natural_key)
    counts = df.groupBy(F.substring(hashed, 1, digits).alias(bucket)).agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(counts, bucket)
    # A row for each bucket: digits and number, some 32 bytes.
    small = 16**digits * 32 <= setting(df.sparkSession, BROADCAST_BYTES)
    in_bucket = Window.partitionBy(bucket).orderBy(digest, *natural_key)
    if small:
        # Digest and bucket are worked out behind the shuffle, and the offset is joined there: rows are shuffled as they are.
        placed = df.repartition(F.substring(hashed, 1, digits)).withColumn(digest, hashed).withColumn(bucket, F.substring(digest, 1, digits))
        placed = placed.join(F.broadcast(offsets), bucket)
    else:
        placed = df.withColumn(bucket, F.substring(hashed, 1, digits)).join(offsets, bucket).withColumn(digest, hashed)
    return (
        placed
        .withColumn(name, (F.row_number().over(in_bucket) + F.col("_offset") + start).cast(as_type))
        .drop(digest, bucket, "_offset")
        .select(name, *df.columns)
    )


def extend_sk(existing: DataFrame, incoming: DataFrame, natural_key: list[str], name: str, top: int | None = None) -> DataFrame:
    """Key map after a load: known keys keep their number, new ones continue after the highest.

    ``top`` says which number that is, where ``existing`` is only a part of the table.
    """
    known = existing.select(name, *natural_key)
    if top is None:
        top = known.agg(F.max(name)).first()[0] or 0
    fresh = settle_keys(without_keys(incoming.select(*natural_key).distinct(), known, natural_key))
    as_type = existing.schema[name].dataType.simpleString()
    return known.unionByName(assign_sk(fresh, natural_key, name, start=top, as_type=as_type))

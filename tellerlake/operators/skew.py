"""Keyed joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerlake.session import BROADCAST_BYTES, FANOUT, HOT_ROWS, setting, settle_keys

_SALT = "_salt"
_HASH = "_hash"
COPIES = "_copies"
# Spark itself would judge a written table by its compressed files and broadcast one that was measured to be too large.
SHUFFLED = "merge"
_SAMPLE_ROWS_PER_HOT_KEY = 20_000


def frame_bytes(df: DataFrame) -> tuple[int, int]:
    """Rows and uncompressed bytes of a frame, from one aggregate over it. Nested columns count by their JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    fixed = sum(8 for f in df.schema if not isinstance(f.dataType, (T.StringType, T.BinaryType, *nested)))
    texts = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    texts += [F.to_json(F.struct(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, nested)]
    text_bytes = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in texts]
    total = sum(text_bytes, F.lit(0))
    rows, chars = df.agg(F.count(F.lit(1)), total).first()
    return rows, rows * fixed + chars


def broadcastable(df: DataFrame) -> bool:
    """Whether the measured size of a frame stays below the limit of a broadcast."""
    return frame_bytes(df)[1] <= setting(df.sparkSession, BROADCAST_BYTES)


class HotKeys:
    """Hashes of the keys that hold very many rows, each with the number of tasks its rows are spread over.

    Every such key holds at least ``HOT_ROWS`` rows, so there are never more of them than the table has rows
    divided by that. The hashes only steer how rows are spread, never which rows match, so
    estimating the counts from a sample is safe.
    """

    def __init__(self, frame: DataFrame, count: int):
        self.frame, self.count = frame, count

    @classmethod
    def of(cls, spark: SparkSession, hashes: list[int]) -> HotKeys:
        """Keys that the caller knows to be hot, by the hash of their columns."""
        copies = setting(spark, FANOUT)
        return cls(spark.createDataFrame([(h, copies) for h in hashes], f"{_HASH} long, {COPIES} int"), len(hashes))

    def __len__(self) -> int:
        return self.count

    def mark(self, df: DataFrame, on: list[str]) -> DataFrame:
        """The rows with the fan-out of their key in :data:`COPIES`, NULL for keys that are not hot."""
        small = self.count * 16 <= setting(df.sparkSession, BROADCAST_BYTES)
        keys = F.broadcast(self.frame) if small else self.frame
        return df.withColumn(_HASH, F.xxhash64(*on)).join(keys, _HASH, "left").drop(_HASH)


def hot_keys(df: DataFrame, on: list[str]) -> HotKeys:
    """The keys of a frame that hold very many rows, all of them."""
    spark = df.sparkSession
    floor = setting(spark, HOT_ROWS)
    fraction = min(1.0, _SAMPLE_ROWS_PER_HOT_KEY / floor)
    keys = df.select(F.xxhash64(*on).alias(_HASH))
    if fraction < 1.0:
        keys = keys.sample(fraction, seed=7)
    counts = keys.groupBy(_HASH).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= floor * fraction)
    spread = F.greatest(F.ceil(F.col("n") / (floor * fraction)), F.lit(setting(spark, FANOUT))).cast("int")
    found = settle_keys(counts.select(_HASH, spread.alias(COPIES)))
    return HotKeys(found, found.count())


def row_salt(df: DataFrame, copies: Column) -> Column:
    """Which of so many tasks a row goes to. It follows the row's content and its input partition, so a task that runs
    again deals its rows as before, and rows that an earlier shuffle gathered in one partition part again."""
    known = [c for c, kind in df.dtypes if "map<" not in kind]
    return F.pmod(F.xxhash64(*known, F.spark_partition_id()), copies).cast("int")


def salted_join(many: DataFrame, one: DataFrame, on: list[str], how: str, hot: HotKeys) -> DataFrame:
    """Equi-join where rows of a hot key go to as many tasks as its rows need and its match is copied to each."""
    marked = hot.mark(many, on)
    spread = marked.withColumn(_SALT, F.when(F.col(COPIES).isNotNull(), row_salt(many, F.col(COPIES))).otherwise(0)).drop(COPIES)
    copies = F.when(F.col(COPIES).isNotNull(), F.sequence(F.lit(0), F.col(COPIES) - 1)).otherwise(F.array(F.lit(0)))
    copied = hot.mark(one, on).withColumn(_SALT, F.explode(copies)).drop(COPIES)
    return spread.join(copied.hint(SHUFFLED), [*on, _SALT], how).drop(_SALT)


def keyed_join(
    many: DataFrame, one: DataFrame, on: list[str], how: str = "left", spread: bool = True
) -> DataFrame:
    """Join ``many`` with a frame that has at most one row per key.

    ``one`` is broadcast only if its measured size stays below the limit; otherwise both sides are
    shuffled and hot keys of ``many`` (a missing key included) are spread. ``spread=False`` skips the
    search for hot keys where the rows per key are known to be few, as after a grouping.
    """
    spark = many.sparkSession
    one = one.withColumns({k: F.col(k).cast(many.schema[k].dataType) for k in on})
    rows, size = frame_bytes(one)
    if rows == 0 and how == "left":
        rest = [f for f in one.schema if f.name not in on]
        return many.withColumns({f.name: F.lit(None).cast(f.dataType) for f in rest})
    if size <= setting(spark, BROADCAST_BYTES):
        return many.join(F.broadcast(one), on, how)
    hot = hot_keys(many, on) if spread else []
    if not hot:
        return many.join(one.hint(SHUFFLED), on, how)
    return salted_join(many, one, on, how, hot)


def split_by_keys(many: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``many`` whose key is among ``keys``, and the rest. The key set is worked out once."""
    present = settle_keys(keys.select(*on).distinct()).withColumn("_present", F.lit(True))
    marked = keyed_join(many, present, on)
    inside = marked.filter(F.col("_present").isNotNull()).drop("_present")
    outside = marked.filter(F.col("_present").isNull()).drop("_present")
    return inside.select(*many.columns), outside.select(*many.columns)


def with_keys(many: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return split_by_keys(many, keys, on)[0]


def without_keys(many: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return split_by_keys(many, keys, on)[1]


def fanout_join(parent: DataFrame, child: DataFrame, on: list[str]) -> DataFrame:
    """Left join of a unique parent to a child with any number of rows per key.

    A hot child key cannot be split by a left join, so in that case children are joined to their
    parent with spreading and childless parents are added.
    """
    hot = hot_keys(child, on)
    if not hot:
        return parent.join(child, on, "left")
    matched = salted_join(child, parent, on, "inner", hot)
    alone = parent.join(child.select(*on).distinct(), on, "left_anti")
    order = [*parent.columns, *[c for c in child.columns if c not in on]]
    return matched.unionByName(alone, allowMissingColumns=True).select(*order)

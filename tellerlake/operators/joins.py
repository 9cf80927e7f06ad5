"""Star-schema joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.operators.skew import HotKeys, frame_bytes, hot_keys, keyed_join, with_keys
from tellerlake.operators.windows import carry_forward
from tellerlake.session import BROADCAST_BYTES, setting, settle_keys


def join_dim(fact: DataFrame, dim: DataFrame, key: str, spread: bool = True) -> DataFrame:
    """Inner join to one dimension; facts of the unknown member (key 0) drop out."""
    return keyed_join(fact, dim, [key], "inner", spread)


def star_join(fact: DataFrame, dims: dict[str, DataFrame], spread: bool = True) -> DataFrame:
    """Inner joins to several dimensions, given by key column."""
    for key, dim in dims.items():
        fact = join_dim(fact, dim, key, spread)
    return fact


def current(dim: DataFrame) -> DataFrame:
    """Versions that are valid now."""
    return dim.filter(F.col("is_current") == 1)


def lookup_sk(fact: DataFrame, dim: DataFrame, natural_key: list[str], sks: list[str], default: int = 0) -> DataFrame:
    """Bring surrogate keys of a dimension into a fact; a miss becomes ``default``."""
    keys = dim.select(*natural_key, *sks)
    found = keyed_join(fact, keys, natural_key)
    return found.withColumns({s: F.coalesce(F.col(s), F.lit(default).cast(keys.schema[s].dataType)) for s in sks})


def join_date(fact: DataFrame, dim_date: DataFrame, date_col: str) -> DataFrame:
    """Add ``date_sk``; a date outside the calendar, or none, becomes 0."""
    days = dim_date.select(F.col("full_date").alias(date_col), "date_sk")
    return keyed_join(fact, days, [date_col]).withColumn("date_sk", F.coalesce("date_sk", F.lit(0).cast("bigint")))


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key values without a parent and the rows that carry them.

    The child is reduced to one row per key value before any join, so a hot key costs nothing.
    """
    refs = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("rows"))
    return refs.join(parent.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose foreign key has no parent."""
    return with_keys(child, orphan_keys(child, fk, parent, pk), [fk])


def asof_dim(
    fact: DataFrame, dim: DataFrame, natural_key: list[str], ts: str, attrs: list[str], segment: str = "hour"
) -> DataFrame:
    """Attributes of the dimension version valid at the time of each fact row.

    A dimension below the broadcast limit goes to every task as one sorted array of versions per key, and each
    fact row finds its version there by binary search: facts are not shuffled. Beyond the limit both sides are laid on one timeline per key and the last version is carried forward, so a key
    with many rows and many versions never pairs all of them. Rows before the first version, or in
    a gap after a closed one, get NULL. If there are hot keys, only the distinct moments of each key
    are laid on the timeline and the rows look their moment up.
    """
    versions = dim.select(*natural_key, "effective_from", "effective_to", *attrs)
    if 0 < frame_bytes(versions)[1] <= setting(fact.sparkSession, BROADCAST_BYTES):
        return _in_arrays(fact, versions, natural_key, ts, attrs)
    hot = hot_keys(fact, natural_key)
    if not hot:
        return _on_timeline(fact, dim, natural_key, ts, attrs, segment, hot)
    moments = fact.select(*natural_key, ts).distinct()
    resolved = _on_timeline(moments, dim, natural_key, ts, attrs, segment, hot)
    found = keyed_join(fact, settle_keys(resolved), [*natural_key, ts])
    return found.select(*fact.columns, *attrs)


def _on_timeline(
    fact: DataFrame, dim: DataFrame, natural_key: list[str], ts: str, attrs: list[str], segment: str, hot: HotKeys
) -> DataFrame:
    version = F.struct(F.col("effective_from").alias("_from"), F.col("effective_to").alias("_to"), *attrs)
    versions = dim.select(*natural_key, F.col("effective_from").alias("_at"), F.lit(0).alias("_side"), version.alias("_version"))
    facts = fact.withColumn("_at", F.col(ts)).withColumn("_side", F.lit(1))
    line = facts.unionByName(versions, allowMissingColumns=True)
    filled = carry_forward(
        line, natural_key, ["_at", "_side"], "_version", "_valid", F.date_trunc(segment, "_at"), inclusive=True, hot=hot
    ).filter(F.col("_side") == 1)
    open_at: Column = F.col("_valid._to").isNull() | (F.col("_at") < F.col("_valid._to"))
    for k in natural_key:  # a missing key matches no version, as in any join
        open_at = open_at & F.col(k).isNotNull()
    return filled.select(*fact.columns, *[F.when(open_at, F.col(f"_valid.{a}")).alias(a) for a in attrs])


def _in_arrays(fact: DataFrame, versions: DataFrame, natural_key: list[str], ts: str, attrs: list[str]) -> DataFrame:
    """As-of attributes by binary search in the versions of the key, of which the broadcast table has a row per key."""
    one = F.struct(F.col("effective_from").alias("_from"), F.col("effective_to").alias("_to"), *attrs)
    usable = versions.filter(F.col("effective_from").isNotNull())
    usable = usable.withColumns({k: F.col(k).cast(fact.schema[k].dataType) for k in natural_key})
    folded = usable.groupBy(*natural_key).agg(F.sort_array(F.collect_list(one)).alias("_versions"))
    found = fact.join(F.broadcast(folded), natural_key, "left")
    at, line = F.col(ts), F.col("_versions")
    # Halving n versions takes as many steps as n has binary digits.
    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(line))))
    start = F.struct(F.lit(0).alias("low"), F.size(line).alias("high"))

    def halve(span: Column, _: Column) -> Column:
        middle = ((span["low"] + span["high"]) / 2).cast("int")
        begun = line[F.least(middle, F.size(line) - 1)]["_from"] <= at
        return F.when(span["low"] >= span["high"], span).when(begun, F.struct((middle + 1).alias("low"), span["high"].alias("high"))).otherwise(F.struct(span["low"].alias("low"), middle.alias("high")))

    count = F.when(line.isNotNull() & at.isNotNull(), F.aggregate(steps, start, halve, lambda span: span["low"])).otherwise(0)
    picked = found.withColumn("_at", count).withColumn("_valid", F.when(F.col("_at") > 0, line[F.col("_at") - 1]))
    open_at = F.col("_valid._to").isNull() | (at < F.col("_valid._to"))
    return picked.select(*fact.columns, *[F.when(open_at, F.col(f"_valid.{a}")).alias(a) for a in attrs])

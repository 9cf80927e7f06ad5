"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.functions.hashing import row_hash
from tellerlake.operators.keys import assign_sk, extend_sk
from tellerlake.operators.skew import hot_keys, keyed_join, split_by_keys
from tellerlake.operators.windows import changed, latest, validity
from tellerlake.session import settle, settle_keys

SCD_COLUMNS = ["effective_from", "effective_to", "is_current"]


def scd2(history: DataFrame, key: list[str], tracked: list[str], ts: str, segment: str = "hour") -> DataFrame:
    """Versions of every key out of all its recorded states.

    Of two states with the same time the one loaded last counts (of one load, the one with the greater
    columns); a state that repeats the tracked attributes of its predecessor opens no version.
    """
    hot = hot_keys(history, key)
    order = [ts, "load_timestamp"] if "load_timestamp" in history.columns and ts != "load_timestamp" else [ts]
    states = latest(history, [*key, ts], order).withColumn("attr_hash", row_hash(*tracked))
    return validity(changed(states, key, ts, "attr_hash", segment, hot), key, ts, segment, hot)


def scd2_apply(
    dim: DataFrame, batch: DataFrame, key: list[str], tracked: list[str], ts: str, segment: str = "hour"
) -> DataFrame:
    """Dimension after a batch: only versions of the keys in the batch are worked out again.

    Batch rows may be late; they are sorted into the timeline of their key. Untouched keys pass
    through unchanged. ``dim`` is a result of :func:`scd2` or of this function.
    """
    affected, untouched = split_by_keys(dim, batch, key)
    states = affected.drop(*SCD_COLUMNS, "attr_hash")
    again = scd2(states.unionByName(batch.select(*states.columns)), key, tracked, ts, segment)
    return untouched.unionByName(again)


def scd2_apply_keyed(
    dim: DataFrame, batch: DataFrame, key: list[str], tracked: list[str], ts: str, sk: str, segment: str = "hour", top: int | None = None
) -> DataFrame:
    """:func:`scd2_apply` on a dimension with surrogate keys.

    A version is known by its key and start: known versions keep their number, new ones continue
    after the highest, so facts that point to the dimension stay right. ``top`` is the highest one, where
    ``dim`` holds only a part of the keys.
    """
    versions = settle(scd2_apply(dim.drop(sk), batch, key, tracked, ts, segment), "versions")
    identity = [*key, "effective_from"]
    numbers = settle_keys(extend_sk(dim.select(sk, *identity), versions, identity, sk, top))
    return keyed_join(versions, numbers, identity, "inner", spread=False).select(sk, *versions.columns)


def number_versions(versions: DataFrame, known: DataFrame | None, key: list[str], sk: str, top: int = 0) -> DataFrame:
    """Numbers for versions such that the open version of a key has the same number for good.

    Facts that point to a key's open version need no change when the key gets another one: the version that
    closes hands its number on and gets a new one. Closed versions are known by key and start and keep theirs.
    ``known`` holds the numbered versions of these keys before, ``top`` is the highest number in use.
    """
    identity = [*key, "effective_from"]
    if known is None:
        numbered = versions.withColumn(sk, F.lit(None).cast("int"))
    else:
        open_now = known.filter("is_current = 1").select(*key, F.col(sk).alias("_open"))
        closed = known.filter("is_current = 0").select(*identity, F.col(sk).alias("_closed"))
        found = keyed_join(keyed_join(versions, open_now, key), closed, identity, spread=False)
        numbered = found.withColumn(sk, F.when(F.col("is_current") == 1, F.col("_open")).otherwise(F.col("_closed"))).drop("_open", "_closed")
    numbered = settle(numbered, "known-numbers")
    kind = numbered.schema[sk].dataType.simpleString()
    # Open versions first, so that the numbers of a first load are dense over the keys.
    fresh = numbered.filter(F.col(sk).isNull()).drop(sk)
    opened = assign_sk(fresh.filter("is_current = 1"), identity, sk, start=top, as_type=kind)
    rest = fresh.filter("is_current = 0")
    past = assign_sk(rest, identity, sk, start=top + fresh.filter("is_current = 1").count(), as_type=kind)
    return numbered.filter(F.col(sk).isNotNull()).unionByName(opened).unionByName(past).select(sk, *versions.columns)

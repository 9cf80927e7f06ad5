"""Keyed merges of load batches into tables without MERGE support."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.operators.skew import keyed_join, split_by_keys, with_keys, without_keys
from tellerlake.operators.windows import duplicate_keys, latest
from tellerlake.session import settle_keys


def union_loads(loads: list[DataFrame], pk: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """All loads of a source by column name; with a key, only the latest row of each key."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), loads)
    return dedupe(rows, pk, order or pk) if pk else rows


def dedupe(df: DataFrame, pk: list[str], order: list[str]) -> DataFrame:
    """Latest row per key when few keys repeat: only rows of repeated keys are shuffled whole.

    Rows without a key are not compared with each other and stay.
    """
    repeated, single = split_by_keys(df, duplicate_keys(df, pk), pk)
    return single.unionByName(latest(repeated, pk, order))


def one_each(df: DataFrame, pk: list[str], order: list[str]) -> DataFrame:
    """The rows of :func:`latest` when few keys repeat: only rows of repeated keys and rows without a key are shuffled whole."""
    repeated, single = split_by_keys(df.filter(~without_key(pk)), duplicate_keys(df, pk), pk)
    return single.unionByName(latest(repeated.unionByName(df.filter(without_key(pk))), pk, order))


def without_key(pk: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in pk])


def _unseen(target: DataFrame, rows: DataFrame, pk: list[str]) -> DataFrame:
    """Rows without a key that the target does not hold yet, each once; such rows are known by all their columns.

    The target is read only if there are any.
    """
    if rows.isEmpty():
        return rows
    shared = [c for c in rows.columns if c in target.columns]
    digest = F.sha2(F.to_json(F.struct(*sorted(shared))), 256)
    known = target.filter(without_key(pk)).select(digest.alias("_digest")).distinct()
    return rows.withColumn("_digest", digest).dropDuplicates(["_digest"]).join(known, "_digest", "left_anti").select(*rows.columns)


def upsert(target: DataFrame, batch: DataFrame, pk: list[str], order: list[str]) -> DataFrame:
    """Target after a merge: the latest row per key wins, wherever it comes from.

    Rows of keys outside the batch pass through without a shuffle while the batch keys are few.
    Rows without a key are never merged with each other: those of the target stay, those of the batch are
    added unless the target already holds the very same row.
    """
    keyed = batch.filter(~without_key(pk))
    known, untouched = split_by_keys(target, keyed, pk)
    touched = known.unionByName(keyed, allowMissingColumns=True)
    merged = untouched.unionByName(latest(touched, pk, order), allowMissingColumns=True)
    return merged.unionByName(_unseen(target, batch.filter(without_key(pk)), pk), allowMissingColumns=True)


def merged_first(batch: DataFrame, pk: list[str], order: list[str]) -> DataFrame:
    """:func:`upsert` into a table that has no rows yet."""
    keyed = one_each(batch.filter(~without_key(pk)), pk, order)
    return keyed.unionByName(_unseen(batch.limit(0), batch.filter(without_key(pk)), pk))


def new_rows(target: DataFrame, batch: DataFrame, pk: list[str], order: list[str]) -> DataFrame:
    """Rows of an insert-only batch: one per key, without keys the target already has.

    Rows without a key are new unless the target already holds the very same row. Keys are compared by themselves; the
    rows then meet the known keys or the new ones, whichever are fewer.
    """
    keyed = one_each(batch.filter(~without_key(pk)), pk, order)
    held = target.select(*[F.col(k).cast(batch.schema[k].dataType).alias(k) for k in pk]).distinct().withColumn("_held", F.lit(True))
    marked = settle_keys(keyed.select(*pk).join(held, pk, "left"))
    known, new = marked.filter("_held").select(*pk), marked.filter("_held IS NULL").select(*pk)
    fresh = with_keys(keyed, new, pk) if new.count() < known.count() else without_keys(keyed, known, pk)
    return fresh.unionByName(_unseen(target, batch.filter(without_key(pk)), pk))


def insert_only(target: DataFrame, batch: DataFrame, pk: list[str], order: list[str]) -> DataFrame:
    return target.unionByName(new_rows(target, batch, pk, order), allowMissingColumns=True)


def soft_delete(current: DataFrame, snapshot: DataFrame, pk: list[str]) -> DataFrame:
    """Set ``is_active`` to 0 on rows whose key is missing from a full snapshot."""
    present = snapshot.select(*pk).distinct().withColumn("_present", F.lit(1))
    marked = keyed_join(current, present, pk)
    return marked.withColumn("is_active", F.coalesce("_present", F.lit(0)).cast("int")).drop("_present")

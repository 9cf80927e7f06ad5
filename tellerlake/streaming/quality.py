"""Quality split and de-duplication on a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tellerlake.functions.masking import mask_pii
from tellerlake.operators.skew import keyed_join
from tellerlake.plans.silver import TableSpec, standardise
from tellerlake.quality.engine import MASK, evaluate_rows, reason_text
from tellerlake.quality.rules import ColumnRule, ForeignKey, Rule
from tellerlake.session import settle, settle_keys
from tellerlake.sources.parts import PartTable, bucket


def first_of_key(stream: DataFrame, key: list[str], event_time: str, delay: str, fanout: int = 32) -> DataFrame:
    """First row of each key within the watermark.

    Repetitions are removed in two stages: within (key, salt), spread over ``fanout`` tasks, and
    then within the key, which by then has at most ``fanout`` rows per batch.
    """
    salted = stream.withWatermark(event_time, delay).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(fanout)))
    return (
        salted.dropDuplicatesWithinWatermark([*key, "_salt"])
        .drop("_salt")
        .dropDuplicatesWithinWatermark(key)
    )


def mark_repeated(rows: DataFrame, key: list[str], known: DataFrame | None) -> DataFrame:
    """Rows that passed, but whose key was written before or comes earlier in the batch, fail as Repeated(key).

    Only keys and row numbers are shuffled to find them. ``rows`` must not change between two readings.
    """
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    first = numbered.filter("dq_passed").groupBy(*key).agg(F.min("_row").alias("_first"))
    if known is not None:
        written = known.withColumn("_written", F.lit(True))
        first = first.join(written, key, "left").select(*key, F.when(F.col("_written"), F.lit(-1)).otherwise(F.col("_first")).alias("_first"))
    joined = keyed_join(numbered, settle_keys(first), key)
    repeated = F.col("dq_passed") & (F.col("_first") != F.col("_row"))
    return joined.withColumns({
        "broken_rules": F.when(repeated, F.lit(f"Repeated({','.join(key)})")).otherwise(F.col("broken_rules")),
        "dq_passed": F.col("dq_passed") & ~F.coalesce(repeated, F.lit(False)),
    }).drop("_row", "_first")


class KeyLedger:
    """Keys that a stream has written, in hash buckets; a batch reads the buckets of its own keys only."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int):
        self.table, self.key, self.buckets = PartTable(spark, path), key, buckets

    def part(self) -> Column:
        return bucket(self.key, self.table.entry().notes.get("buckets", self.buckets))

    def known(self, rows: DataFrame, number: int) -> DataFrame | None:
        """Keys of these rows that other batches have written."""
        entry = self.table.entry()
        if not entry.version:
            return None
        touched = {r[0] for r in rows.select(self.part().alias("part")).distinct().collect()}  # at most a name a bucket
        return self.table.read(touched, entry).filter(F.col("batch") != number).select(*self.key).distinct()

    def add(self, rows: DataFrame, number: int) -> None:
        buckets = self.table.entry().notes.get("buckets", self.buckets)
        self.table.append(rows.select(*self.key, F.lit(number).cast("bigint").alias("batch")), self.part(), {"buckets": buckets})


def stream_dq(
    stream: DataFrame, rules: Sequence[Rule], silver: str, quarantine: str, checkpoint: str, key: list[str] | None = None,
    spec: TableSpec | None = None, parents: Mapping[str, DataFrame] | None = None, buckets: int = 256,
) -> StreamingQuery:
    """Write rows that keep the rules to ``silver`` and the others, with reasons, to ``quarantine``.

    Rules that look at single rows apply as they are, foreign keys against ``parents``. With ``spec`` rows are masked and
    standardised as the nightly silver build does, in quarantine too; without, the stream must hold no
    personal data. With ``key``, the first row of a key that passes goes to silver, and repetitions go to quarantine, however
    late they come: every row of the stream is in one of the two. Written keys are known from a ledger beside silver,
    of which a batch reads the buckets of its own keys. Each batch goes to a folder of its own number, so a
    repeated batch replaces what its first attempt left behind.
    """
    checks = [r for r in rules if isinstance(r, ColumnRule) or isinstance(r, ForeignKey) and parents]

    def write(batch: DataFrame, number: int) -> None:
        rows = evaluate_rows(batch, checks, parents).withColumn("broken_rules", reason_text(checks)).drop(MASK)
        rows = settle(rows, "stream-batch")
        if key:
            ledger = KeyLedger(batch.sparkSession, f"{silver}-keys", key, buckets)
            rows = settle(mark_repeated(rows, key, ledger.known(rows, number)), "stream-rows")
        passed, failed = rows.filter("dq_passed").drop("dq_passed", "broken_rules"), rows.filter("NOT dq_passed").drop("dq_passed")
        if spec:
            passed, failed = standardise(passed, spec), mask_pii(failed) if spec.masked else failed
        passed.write.mode("overwrite").parquet(f"{silver}/batch={number}")
        failed.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
        if key:
            ledger.add(rows.filter("dq_passed"), number)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

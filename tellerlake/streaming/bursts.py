"""Failure bursts on a stream of job events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def failure_burst(
    events: DataFrame, window: str = "1 hour", slide: str = "5 minutes", least: int = 2, delay: str = "10 minutes"
) -> DataFrame:
    """Sliding windows with at least ``least`` failed jobs.

    ``events`` has ts and status. Every job moves the watermark on, successful ones are then dropped
    before rows are copied into windows; the condition names the time, else Spark would filter first.
    In append mode a window comes out once the watermark has passed it, in update mode at once.
    """
    failed = F.when(F.col("ts").isNotNull(), F.col("status") == "FAILED").otherwise(False)
    failures = events.select("ts", "status").withWatermark("ts", delay).filter(failed).select("ts")
    counted = failures.groupBy(F.window("ts", window, slide).alias("w")).agg(F.count(F.lit(1)).alias("failures"))
    return counted.filter(F.col("failures") >= least).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "failures"
    )


def alert_bursts(bursts: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write each window as soon as it counts as a burst, and again when its count grows.

    A batch goes to a folder of its number, so a repeated one replaces its first attempt.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return (
        bursts.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_bursts(bursts: DataFrame) -> DataFrame:
    """The written windows with their latest, that is largest, counts."""
    return bursts.groupBy("window_start", "window_end").agg(F.max("failures").alias("failures"))

"""File streams into bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tellerlake.functions.casting import enforce_types
from tellerlake.functions.hashing import row_hash
from tellerlake.sources.landing import landing_ddl


def landing_stream(spark: SparkSession, path: str, types: dict[str, str], pattern: str, files_per_trigger: int = 1000) -> DataFrame:
    """New landing files as a stream of typed rows with file name and fingerprint."""
    columns = list(types)
    text = (
        spark.readStream.schema(landing_ddl(columns))
        .option("header", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", pattern)
        .csv(path)
        .select(*columns, F.col("_metadata.file_name").alias("src_file_name"))
    )
    typed = enforce_types(text, types)
    return typed.withColumns({"row_hash": row_hash(*columns), "is_active": F.lit(1), "pipeline_phase": F.lit("bronze")})


def stream_bronze(stream: DataFrame, target: str, checkpoint: str, src_system: str = "stream") -> StreamingQuery:
    """Append everything that has arrived and stop; the checkpoint remembers the files taken.

    A file is taken once, however often this runs. Each batch goes to a folder of its own number with the
    audit columns of its load, so a repeated batch replaces what its first attempt left behind.
    """

    def write(batch: DataFrame, number: int) -> None:
        now = F.current_timestamp()
        audited = batch.withColumns({"src_system": F.lit(src_system), "load_timestamp": now, "load_date": F.to_date(now), "batch_id": F.lit(f"stream-{number:010d}")})
        audited.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query and raise what made it fail."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()

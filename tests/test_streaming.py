from __future__ import annotations

from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from conformance import mapping
from tellerlake.plans.observability import failure_bursts
from tellerlake.plans.silver import SPEC, strict_rules
from tellerlake.quality.rules import RULES
from tellerlake.streaming.bursts import alert_bursts, failure_burst, read_bursts
from tellerlake.streaming.ingest import landing_stream, run_to_end, stream_bronze
from tellerlake.streaming.quality import KeyLedger, first_of_key, stream_dq

TYPES = {"txn_id": "bigint", "gateway_name": "string", "processed_timestamp": "timestamp"}


def test_files_are_taken_once(spark, tmp_path):
    landing, target, checkpoint = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "cp")
    landing.mkdir()

    def load():
        run_to_end(stream_bronze(landing_stream(spark, str(landing), TYPES, "payment_*.csv"), target, checkpoint))
        return spark.read.parquet(target)

    header = "txn_id,gateway_name,processed_timestamp\n"
    (landing / "payment_1.csv").write_text(header + "1, Stripe ,2024-01-01 00:00:00\nx,PayU,2024-01-01 00:00:01\n")
    (landing / "ignored.csv").write_text(header + "7,PayU,2024-01-01 00:00:01\n")
    assert rows(load(), "txn_id", "gateway_name", "src_file_name") == [(None, "PayU", "payment_1.csv"), (1, "Stripe", "payment_1.csv")]
    assert load().count() == 2
    (landing / "payment_2.csv").write_text(header + "2,PayU,2024-01-02 00:00:00\n")
    assert load().count() == 3
    assert load().filter("length(row_hash) = 32 AND is_active = 1").count() == 3


def payments(spark, path, data):
    schema = "txn_id long, gateway_name string, gateway_status string, response_code string, processing_time_ms long, device_type string, processed_timestamp timestamp"
    spark.createDataFrame([(i, "Stripe", s, "00", 5, "Web", t) for i, s, t in data], schema).repartition(4).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def test_stream_quality_split_and_deduplication(spark, tmp_path):
    src, silver, quarantine, checkpoint = (str(tmp_path / n) for n in ("src", "silver", "quarantine", "cp"))
    t = datetime(2024, 1, 1)
    # One key holds many copies.
    first = [(1, "SUCCESS", t)] * 200 + [(2, "SUCCESS", t), (3, "BROKEN", t)]

    def load(data):
        stream = first_of_key(payments(spark, src, data), ["txn_id"], "processed_timestamp", "2 hours", fanout=4)
        run_to_end(stream_dq(stream, RULES["payment_gateway_logs"], silver, quarantine, checkpoint))

    load(first)
    assert rows(spark.read.parquet(silver), "txn_id") == [(1,), (2,)]
    load([(2, "SUCCESS", t + timedelta(minutes=5)), (4, "PENDING", t + timedelta(minutes=5))])
    assert rows(spark.read.parquet(silver), "txn_id") == [(1,), (2,), (4,)]
    assert rows(spark.read.parquet(quarantine), "txn_id", "broken_rules") == [(3, "InSet(gateway_status)")]


def test_failure_bursts_stream_equals_batch(spark, tmp_path):
    t = datetime(2024, 1, 1)
    data = [(t + timedelta(minutes=m), s) for m, s in [(0, "FAILED"), (30, "FAILED"), (31, "SUCCESS"), (200, "FAILED"), (300, "FAILED"), (301, "FAILED"), (900, "SUCCESS"), (901, "FAILED")]]
    batch = spark.createDataFrame(data, "ts timestamp, status string")
    batch.write.parquet(str(tmp_path / "src"))
    stream = failure_burst(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "src")))
    run_to_end(
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        .outputMode("append").trigger(availableNow=True).start()
    )
    expected = failure_bursts(batch)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(expected)
    assert expected.count() > 10


def test_bursts_are_alerted_at_once(spark, tmp_path):
    t = datetime(2024, 1, 1)
    data = [(t + timedelta(minutes=m), s) for m, s in [(0, "FAILED"), (30, "FAILED"), (300, "FAILED"), (301, "FAILED"), (302, "FAILED")]]
    batch = spark.createDataFrame(data, "ts timestamp, status string")
    for part in (batch.filter(F.col("ts") <= t + timedelta(minutes=300)), batch.filter(F.col("ts") > t + timedelta(minutes=300))):
        part.write.mode("append").parquet(str(tmp_path / "src"))
        stream = failure_burst(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "src")))
        run_to_end(alert_bursts(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    # The last burst is there although nothing came after it.
    assert rows(read_bursts(spark.read.parquet(str(tmp_path / "out")))) == rows(failure_bursts(batch))


def test_successful_jobs_move_time_on(spark, tmp_path):
    t = datetime(2024, 1, 1)
    shape = "ts timestamp, status string"
    for data in ([(t, "FAILED"), (t, "FAILED")], [(t + timedelta(hours=5), "SUCCESS")]):
        spark.createDataFrame(data, shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
        stream = failure_burst(spark.readStream.schema(shape).parquet(str(tmp_path / "src")))
        run_to_end(
            stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
            .outputMode("append").trigger(availableNow=True).start()
        )
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12


def test_late_and_repeated_rows_go_to_quarantine(spark, tmp_path):
    src, silver, quarantine, checkpoint = (str(tmp_path / n) for n in ("src", "silver", "quarantine", "cp"))
    t = datetime(2024, 1, 5)
    loads = [
        [(1, "SUCCESS", t)] * 20 + [(2, "BROKEN", t), (3, "SUCCESS", t)],
        [(3, "SUCCESS", t + timedelta(days=3)), (4, "SUCCESS", t + timedelta(days=3)), (None, "SUCCESS", t)],
        [(5, "SUCCESS", t - timedelta(days=9)), (2, "SUCCESS", t), (1, "FAILED", t + timedelta(days=9))],
    ]
    for data in loads:
        stream = payments(spark, src, data)
        run_to_end(stream_dq(stream, RULES["payment_gateway_logs"], silver, quarantine, checkpoint, ["txn_id"]))
    assert rows(spark.read.parquet(silver), "txn_id") == [(1,), (2,), (3,), (4,), (5,)]
    failed = rows(spark.read.parquet(quarantine), "txn_id", "broken_rules")
    assert failed == [(None, "Completeness(txn_id)")] + [(1, "Repeated(txn_id)")] * 20 + [(2, "InSet(gateway_status)"), (3, "Repeated(txn_id)")]
    assert spark.read.parquet(src).count() == 5 + len(failed)


def test_streamed_bronze_has_the_audit_columns_of_its_load(spark, tmp_path):
    landing, target, checkpoint = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "cp")
    landing.mkdir()
    for n in (1, 2):
        (landing / f"payment_{n}.csv").write_text(f"txn_id,gateway_name,processed_timestamp\n{n},PayU,2024-01-01 00:00:00\n")
        run_to_end(stream_bronze(landing_stream(spark, str(landing), TYPES, "payment_*.csv"), target, checkpoint, "payments_csv"))
    found = spark.read.parquet(target)
    assert rows(found, "txn_id", "src_system", "batch_id") == [(1, "payments_csv", "stream-0000000000"), (2, "payments_csv", "stream-0000000001")]
    assert found.filter("load_timestamp IS NULL OR load_date IS NULL OR src_file_name IS NULL OR row_hash IS NULL").count() == 0


def test_streamed_customers_are_masked_and_standardised(spark, tmp_path):
    src, silver, quarantine, checkpoint = (str(tmp_path / n) for n in ("src", "silver", "quarantine", "cp"))
    mapping.source(spark, "/root/testdata/sf0.001", "customers").write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    parents = {"branches": spark.createDataFrame([(f"BR{n:03d}",) for n in range(1, 26) if n != 7], "branch_code string")}
    run_to_end(stream_dq(stream, strict_rules("customers"), silver, quarantine, checkpoint, ["customer_id"], SPEC["customers"], parents))
    passed, failed = spark.read.parquet(silver), spark.read.parquet(quarantine)
    for df in (passed, failed):
        assert not {"pan_number", "email", "phone_number"} & set(df.columns) and "pan_masked" in df.columns
    assert passed.filter("branch_code = 'BR007' OR first_name <> trim(first_name)").count() == 0
    assert failed.filter("broken_rules LIKE '%ForeignKey(branch_code)%'").count() > 0
    assert passed.count() + failed.count() == 150


def test_keys_read_follow_the_batch(spark, tmp_path):
    """Of a ledger of 5,000 keys in 256 buckets, a batch with one key reads one bucket."""
    ledger = KeyLedger(spark, str(tmp_path / "keys"), ["k"], 256)
    for number in range(3):
        ledger.add(spark.range(number * 2000, number * 2000 + 2000).withColumnRenamed("id", "k"), number)
    one = spark.createDataFrame([(4321,)], "k long")
    known = ledger.known(one, 9)
    assert known.filter("k = 4321").count() == 1 and known.count() < 100
    assert len(known.inputFiles()) <= 3
    assert ledger.known(one, 2).filter("k = 4321").count() == 0  # its own batch does not count

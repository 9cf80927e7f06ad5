"""Landing files by ledger, corrupt lines, reprocessed rows."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conformance import mapping
from tellerlake.plans import nightly
from tellerlake.plans.reprocessing import reprocess_quarantine
from tellerlake.session import settle
from tellerlake.sources.files import batch_manifest, ledger, load_files, new_files
from tellerlake.sources.lake import Lake
from tellerlake.sources.landing import CORRUPT, read_landing_csv
from tests.conftest import rows

TYPES = {"txn_id": "bigint", "name": "string", "at": "timestamp"}
HEADER = "txn_id,name,at\n"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_every_file_is_loaded_once_whatever_its_rows(lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def load(batch):
        return load_files(lake, "pay", str(landing), TYPES, batch, datetime(2025, 3, int(batch[1:])), "pay_*.csv")

    assert load("b1") == 0
    (landing / "pay_2.csv").write_text(HEADER + "2,x,2024-02-01 00:00:00\n3,y,2024-02-02 00:00:00\n")
    (landing / "pay_3.csv").write_text(HEADER)  # no rows, and still a file that was taken
    assert load("b1") == 2 and load("b2") == 0
    (landing / "pay_1.csv").write_text(HEADER + "1,old,2020-01-01 00:00:00\n")  # comes later, with older rows
    assert load("b2") == 1
    assert rows(lake.read("bronze", "pay"), "txn_id", "src_file_name", "batch_id") == [(1, "pay_1.csv", "b2"), (2, "pay_2.csv", "b1"), (3, "pay_2.csv", "b1")]
    assert rows(batch_manifest(lake, ["pay", "other"]), "batch_id", "files_processed", "rows", "corrupt_rows", "status") == [("b1", 2, 2, 0, "LOADED"), ("b2", 1, 1, 0, "LOADED")]
    (landing / "pay_2.csv").write_text(HEADER + "9,again,2024-02-01 00:00:00\n")  # the same name with another content
    os.utime(landing / "pay_2.csv", (1, 1))
    assert rows(new_files(lake, "pay", str(landing), "pay_*.csv"), "file_name") == [("pay_2.csv",)]


def test_a_load_that_stopped_is_repeated_whole(lake, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "pay_1.csv").write_text(HEADER + "1,a,2024-01-01 00:00:00\n")
    args = (lake, "pay", str(landing), TYPES, "b1", datetime(2025, 3, 1))
    with monkeypatch.context() as broken:
        broken.setattr("tellerlake.sources.files.keyed_join", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load_files(*args)
    assert ledger(lake, "pay").count() == 0
    assert load_files(*args) == 1
    assert lake.read("bronze", "pay").count() == 1


def test_lines_with_other_fields_are_kept_apart(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "pay_1.csv").write_text(HEADER + '1,a,2024-01-01 00:00:00\n2,b\n3,c,2024-01-01 00:00:00,more\n4,"x,y",not a time\n5,,\n')
    text = settle(read_landing_csv(spark, str(landing), list(TYPES), corrupt=True))  # Spark refuses to read that column alone from the files
    assert rows(text.filter(F.col(CORRUPT).isNotNull()), CORRUPT) == [("2,b",), ("3,c,2024-01-01 00:00:00,more",)]
    assert text.select(CORRUPT, "txn_id").filter(F.col(CORRUPT).isNull()).count() == 3  # fields are counted even if few are read
    load_files(lake, "pay", str(landing), TYPES, "b1", datetime(2025, 3, 1))
    assert rows(lake.read("bronze", "pay"), "txn_id", "name") == [(1, "a"), (4, "x,y"), (5, None)]
    assert rows(lake.read("quarantine", "pay_lines"), "line", "src_file_name") == [("2,b", "pay_1.csv"), ("3,c,2024-01-01 00:00:00,more", "pay_1.csv")]
    assert ledger(lake, "pay").first().status == "PARTIAL"


def test_corrected_rows_go_back_to_silver_once(lake):
    spark = lake.spark
    good = mapping.source(spark, "/root/testdata/sf0.001", "accounts").filter("balance >= 0").limit(30)
    broken = good.withColumns({
        "balance": F.when(F.col("account_id") % 2 == 0, F.lit(-5).cast("decimal(18,2)")).otherwise(F.col("balance")),
        "currency": F.when(F.col("account_id") % 3 == 0, F.lit("EUR")).otherwise(F.col("currency")),
    })
    first = nightly.Run(lake, datetime(2025, 3, 1), "r1", [])
    nightly.ingest(first, "accounts", broken)
    passed = nightly.refine(first, "accounts", halt=False)
    later = nightly.Run(lake, datetime(2025, 3, 2), "r2", [])
    fix = lambda df: df.withColumn("balance", F.greatest("balance", F.lit(0).cast("decimal(18,2)")))
    ids = [r.account_id for r in broken.collect()]
    mendable = [i for i in ids if i % 2 == 0 and i % 3 != 0]
    assert reprocess_quarantine(later, "accounts", fix) == len(mendable)
    assert lake.read("silver", "accounts").count() == passed + len(mendable)
    failed = lake.read("quarantine", "accounts")
    assert rows(failed.filter("dq_status = 'REPROCESSED'"), "account_id", "reprocess_ts") == [(i, datetime(2025, 3, 2)) for i in sorted(mendable)]
    assert failed.count() == 30 - passed
    assert reprocess_quarantine(nightly.Run(lake, datetime(2025, 3, 3), "r3", []), "accounts", fix) == 0
    assert lake.read("silver", "accounts").count() == passed + len(mendable)

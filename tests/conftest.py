from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tight(spark):
    """Nothing may be broadcast, and three rows already make a key hot."""
    settings = {
        "tellerlake.broadcast.maxBytes": "0",
        "tellerlake.skew.hotRows": "3",
        "tellerlake.skew.fanout": "4",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def rows(df, *cols):
    """Rows as sorted tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))

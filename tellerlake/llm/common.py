"""Small helpers of the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """The column of that very name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; other columns cannot clash with them."""
    return df.select(*[column(source).alias(name) for name, source in columns.items()])


def worker_state() -> dict:
    """A dictionary of this Python worker process; it outlives tasks, so that caches stay warm."""
    name = "_training_data_worker_state"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return vars(sys.modules[name]).setdefault("state", {})


def in_small(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that what a function makes of them stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)

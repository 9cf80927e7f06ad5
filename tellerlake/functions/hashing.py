"""Row fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_text(*cols: str) -> Column:
    """String form of the columns joined by ``|``; NULL takes part as the text ``None``."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in cols])


def row_hash(*cols: str) -> Column:
    """MD5 hex of :func:`row_text`."""
    return F.md5(row_text(*cols))

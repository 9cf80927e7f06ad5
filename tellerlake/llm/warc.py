"""WARC archives: writing pages as segmented records with chunked HTTP bodies, and reading them back.

Writing: a page becomes a response record, or a revisit record if another page with the same
payload (of at least ``revisit_from`` bytes) has a smaller id. A record block longer than
``segment_bytes`` is cut into segments: the first keeps the record's type, the others are
continuation records that name it in WARC-Segment-Origin-ID; the last carries the total length.
Segments of a page may lie in several archives.

Reading: archives are parsed record by record, segments are grouped by their origin, ordered by
segment number, checked against the total length and joined, and the chunked transfer framing is
taken off. A revisit has no body; its payload is that of the record it refers to.

An archive holds at most ``ARCHIVE_RECORDS`` records of at most ``segment_bytes`` and some headers,
so one task reads a bounded file. Archives are text files of Spark's own writer: the
separator of its lines is the end mark of a record; each archive is one gzip member.

Defined results: a null payload is an empty one; a null page id is never a target of a revisit and
its page is always a response; of repeated rows that share the smallest id all are responses; an empty
table makes no archive and gives no rows. Columns other than id, url and payload are not read.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm.common import picked
from tellerlake.session import scratch_path, settle

END = "\r\n\r\n"
ARCHIVE_RECORDS = 512
SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 8 * 1024
REVISIT_FROM = 100


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing: each chunk after its length in hexadecimal, an empty chunk at the end."""
    framed = [b"%x\r\n%b\r\n" % (len(part), part) for part in (payload[k : k + size] for k in range(0, len(payload), size))]
    return b"".join([*framed, b"0\r\n\r\n"])


def unchunked(framed: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped. A broken frame is an error."""
    parts, at = [], 0
    while True:
        line_end = framed.index(b"\r\n", at)
        size = int(framed[at:line_end].split(b";")[0], 16)
        at = line_end + 2
        if not size:
            return b"".join(parts)
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its length says")
        parts.append(framed[at : at + size])
        at += size + 2


def header(fields: dict[str, object]) -> bytes:
    # A line break inside a value would end the field.
    lines = [f"{k}: {re.sub(r'[\r\n]+', ' ', str(v))}" for k, v in fields.items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines]).encode() + b"\r\n\r\n"


def with_types(pages: DataFrame, revisit_from: int) -> DataFrame:
    """Adds digest, bytes and refers_to (null for responses)."""
    marked = pages.withColumns({"digest": F.sha2(F.col("payload").cast("binary"), 256), "bytes": F.octet_length("payload").cast("long")})
    first = (
        marked.select("page_id", "digest", "bytes").filter((F.col("bytes") >= revisit_from) & F.col("page_id").isNotNull())
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).filter("first < last").select("digest", "first")
    )
    return marked.join(first, "digest", "left").withColumn("refers_to", F.when(F.col("first") < F.col("page_id"), F.col("first"))).drop("first")


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES, revisit_from: int = REVISIT_FROM,
) -> None:
    """Write a record per page under ``path``."""
    source = picked(pages, page_id=id_col, url=url_col, payload=payload_col).withColumns(
        {"payload": F.coalesce("payload", F.lit("")), "nth": F.monotonically_increasing_id()}
    )
    typed = with_types(source, revisit_from)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                revisit, payload = row["refers_to"] is not None, row["payload"] or b""
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n".encode()
                block = head if revisit else head + chunked(payload, chunk_bytes)
                name = f"urn:page:{'' if row['page_id'] is None else row['page_id']}:{row['nth']:x}"
                cuts = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
                out = []
                for k, part in enumerate(cuts, 1):
                    own = {
                        "WARC-Type": "continuation" if k > 1 else "revisit" if revisit else "response",
                        "WARC-Record-ID": f"<{name}{f':{k}' if k > 1 else ''}>",
                        "WARC-Date": "2025-01-01T00:00:00Z", "WARC-Target-URI": row["url"], "Content-Type": "application/http;msgtype=response",
                        "WARC-Payload-Digest": f"sha256:{row['digest']}" if k == 1 else None,
                        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
                        "WARC-Refers-To": f"<urn:page:{row['refers_to']}>" if revisit else None,
                        "WARC-Segment-Number": k if len(cuts) > 1 else None, "WARC-Segment-Origin-ID": f"<{name}>" if k > 1 else None,
                        "WARC-Segment-Total-Length": len(block) if 1 < k == len(cuts) else None, "Content-Length": len(part),
                    }
                    out.append(header(own) + part)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    # Revisits carry no body: their payload needs no trip to the workers.
    sent = typed.select(
        "page_id", "url", "digest", "refers_to", "nth", F.when(F.col("refers_to").isNull(), F.col("payload").cast("binary")).alias("payload")
    )
    made = sent.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value"))
    made.write.option("lineSep", END).option("maxRecordsPerFile", ARCHIVE_RECORDS).option("compression", "gzip").text(path)


def unzipped(data: bytes) -> bytes:
    return gzip.decompress(data) if data.startswith(b"\x1f\x8b") else data


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive: header fields (names in lower case) and block."""
    at = 0
    while at < len(archive):
        head_end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:head_end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        begin, size = head_end + 4, int(fields["content-length"])
        if archive[begin + size : begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, archive[begin : begin + size]
        at = begin + size + 4


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Every record of all archives under ``path``, segments still apart."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("content"):
                rows = []
                for f, block in parse(unzipped(archive.as_py())):
                    own = f.get("warc-record-id", "").strip("<>")
                    rows.append({
                        "origin": f.get("warc-segment-origin-id", own).strip("<>"), "number": int(f.get("warc-segment-number", 1)),
                        "total": int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None,
                        "segmented": "warc-segment-number" in f, "type": f["warc-type"], "url": f.get("warc-target-uri"),
                        "digest": f.get("warc-payload-digest", "").partition(":")[2] or None,
                        "refers_to": f["warc-refers-to"].strip("<>") if "warc-refers-to" in f else None, "block": block,
                    })
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=shape)

    shape = pa.schema([
        ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("segmented", pa.bool_()), ("type", pa.string()),
        ("url", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()), ("block", pa.binary()),
    ])
    schema = "origin string, number int, total long, segmented boolean, type string, url string, digest string, refers_to string, block binary"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(records, schema)


def reassembled(segments: DataFrame) -> DataFrame:
    """One row per record: page_id, type, url, digest, refers_to, payload (null for revisits) and whole.

    ``whole`` says that all segments are there and their lengths add up; else the payload is null.
    Records that were never cut take no part in the shuffle.
    """
    shown = ["origin", "type", "url", "digest", "refers_to"]
    single = segments.filter(~F.col("segmented")).select(*shown, "block", F.lit(True).alias("whole"))
    ordered = F.array_sort(F.collect_list(F.struct("number", "block")))
    head = F.min(F.when(F.col("number") == 1, F.struct("type", "url", "digest", "refers_to")))
    groups = segments.filter("segmented").groupBy("origin").agg(ordered.alias("parts"), F.max("total").alias("total"), head.alias("head"))
    joined = groups.select(
        "origin", "head.*", F.aggregate("parts", F.lit(b""), lambda whole, p: F.concat(whole, p["block"])).alias("block"),
        F.col("total"), (F.transform("parts", lambda p: p["number"]) == F.sequence(F.lit(1), F.size("parts"))).alias("gapless"),
    )
    fits = F.coalesce((F.octet_length("block") == F.col("total")) & F.col("gapless") & F.col("type").isNotNull(), F.lit(False))
    records = single.unionByName(joined.select(*shown, "block", fits.alias("whole")))

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for block, kind, whole in zip(batch.column("block"), batch.column("type"), batch.column("whole"), strict=True):
                head, _, body = block.as_py().partition(b"\r\n\r\n")
                framed = b"transfer-encoding: chunked" in head.lower()
                found.append(None if kind.as_py() != "response" or not whole.as_py() else unchunked(body) if framed else body)
            kept = [batch.column(c) for c in (*shown, "whole")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.binary())], names=[*shown, "whole", "payload"])

    decoded = records.mapInArrow(bodies, "origin string, type string, url string, digest string, refers_to string, whole boolean, payload binary")
    number = F.regexp_extract("origin", r"^urn:page:(-?\d+):", 1)
    return decoded.withColumn("page_id", number.try_cast("long"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every page of the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest of a response are taken from its decoded payload, those of a revisit from the
    response that it refers to. A revisit whose target is missing, or a broken record, has null lengths.
    """
    records = settle(
        reassembled(read_segments(spark, path)).select(
            "page_id", "url", "type", F.regexp_extract("refers_to", r"^urn:page:(-?\d+)$", 1).try_cast("long").alias("refers_to"),
            F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        ), "warc-pages",
    )
    shown = ["page_id", "url", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to"]
    responses = records.filter("type = 'response'").select(*shown)
    targets = (
        records.filter("type = 'response' and page_id is not null").groupBy("page_id")
        .agg(F.min(F.struct("payload_bytes", "payload_digest")).alias("target")).select(F.col("page_id").alias("refers_to"), "target")
    )
    revisits = records.filter("type = 'revisit'").drop("payload_bytes", "payload_digest").join(targets, "refers_to", "left")
    found = revisits.withColumns({"payload_bytes": F.col("target.payload_bytes"), "payload_digest": F.col("target.payload_digest")})
    return responses.unionByName(found.select(*shown))


def roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write archives into the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, payload_col)
    return read_archives(spark, path).withColumnRenamed("page_id", id_col)

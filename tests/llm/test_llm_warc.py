"""Archives: exact round trip, framing, damaged archives, awkward input."""

from __future__ import annotations

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tellerlake.llm import warc


def rows():
    rng = random.Random(1)
    big = "".join(rng.choice("abc é\r\n") for _ in range(30_000))
    out = [
        (1, "u1", "short"), (2, "u2", "short"), (3, "u3", None), (4, "u4", ""), (5, "u5", big), (6, "u6", big), (7, "u7\r\nWARC-Type: x", "x" * 99), (8, None, "x" * 99),
        (9, "u9", "y" * 100), (10, "u10", "y" * 100), (10, "u10", "y" * 100), (11, "u11", "é" * 50), (12, "u12", "é" * 50), (None, "n", big), (None, None, None),
        (13, "u13", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9), (14, "u14", "0\r\n\r\n" * 40), (-3, "neg", "z" * 500), (20, "u", "z" * 500),
        (15, "a", "w" * 200), (15, "b", "w" * 200),
    ]
    return out + [(100 + i, f"u{i}", "".join(rng.choice("<p>abc ñ\n") for _ in range(rng.randint(0, 3000)))) for i in range(60)]


def expected(pages):
    first = {}
    for i, _, html in pages:
        data = (html or "").encode()
        if i is not None and len(data) >= 100:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        target = first.get(data)
        revisit = i is not None and target is not None and target < i
        out.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", target if revisit else None))
    return sorted(out, key=str)


def found(df):
    return sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.mark.parametrize(("segment", "chunk", "records"), [(64 * 1024, 8 * 1024, 512), (300, 50, 7), (97, 1000, 2)])
def test_round_trip(spark, tmp_path, monkeypatch, segment, chunk, records):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", records)
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("payload", "digest", "nth", "first")})
    warc.write_archives(pages, str(tmp_path / "a"), segment_bytes=segment, chunk_bytes=chunk)
    assert found(warc.read_archives(spark, str(tmp_path / "a"))) == expected(rows())
    kinds = [f["warc-type"] for p in (tmp_path / "a").glob("*.gz") for f, _ in warc.parse(gzip.decompress(p.read_bytes()))]
    assert ("continuation" in kinds) == (segment < 60_000) and kinds.count("revisit") == sum(r[3] == "revisit" for r in expected(rows()))


def test_query_form_and_no_pages(spark):
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string")
    assert found(warc.roundtrip(pages)) == expected(rows())
    assert warc.roundtrip(pages.limit(0)).collect() == []


def test_chunks():
    rng = random.Random(2)
    for size in (1, 3, 16, 1000):
        data = bytes(rng.choice(b"a\r\n0") for _ in range(200))
        assert warc.unchunked(warc.chunked(data, size)) == data
    assert warc.unchunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")


def segment(origin, number, block, total=None):
    kind = "response" if number == 1 else "continuation"
    return warc.header({
        "WARC-Type": kind, "WARC-Record-ID": f"<{origin}{'' if number == 1 else f':{number}'}>", "WARC-Segment-Number": number,
        "WARC-Segment-Origin-ID": None if number == 1 else f"<{origin}>", "WARC-Segment-Total-Length": total, "Content-Length": len(block),
    }) + block + b"\r\n\r\n"


def test_reassembly_verifies_segments(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"0123456789" * 3, 7)
    parts = [body[:20], body[20:50], body[50:]]
    whole, missing, wrong, headless = ([segment(f"urn:page:{i}:0", k + 1, p, (len(body) + (i == 3)) if k == 2 else None) for k, p in enumerate(parts)] for i in (1, 2, 3, 4))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "one.warc").write_bytes(whole[2] + missing[0] + wrong[1] + headless[1])
    (tmp_path / "b" / "two.warc").write_bytes(whole[0] + wrong[2] + wrong[0] + headless[2])
    (tmp_path / "b" / "three.warc.gz").write_bytes(gzip.compress(whole[1]) + gzip.compress(missing[2]))
    got = {r.origin: r for r in warc.reassembled(warc.read_segments(spark, str(tmp_path / "b"))).collect()}
    assert bytes(got["urn:page:1:0"].payload) == b"0123456789" * 3 and got["urn:page:1:0"].whole and got["urn:page:1:0"].page_id == 1
    for i in (2, 3, 4):
        assert not got[f"urn:page:{i}:0"].whole and got[f"urn:page:{i}:0"].payload is None


def test_broken_records():
    with pytest.raises(ValueError):
        list(warc.parse(b"nonsense\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))

"""Personal data: base spans against plain patterns, learning, masking, awkward input."""

from __future__ import annotations

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from tellerlake.llm import pii


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    spans += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15]
    return spans


def test_base_spans_equal_plain_patterns():
    rng = random.Random(3)
    parts = ["a", "b.c", "@", "@x.com", "a@b", ".", "..", "-", "+1 (555) 555-1234", "+", "1.2.3.4", "256.1.1.1", "007.1.1.1", "4111 1111 1111 1111", "4111111111111112", " ", "9", "+4", "é", "\n", "(", "%"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == plain_spans(text), repr(text)


def test_time_in_proportion_to_the_text():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 100_000, "+1" + "(" * 300_000, "1 " * 150_000, "a.b@c " * 30_000):
        start = time.process_time()
        pii.candidates(text)
        assert time.process_time() - start < 10


def test_awkward_documents(awkward, no_docs):
    extra = awkward.withColumn("text", F.concat_ws(" ", F.col("text"), F.lit("mail me@here.org or +1 555 555 1234, 10.0.0.1; card 4111 1111 1111 1111")))
    for docs in (awkward, extra):
        found = pii.find(docs).collect()
        texts = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
        assert len(found) == len(texts)
        wanted = []
        for doc, text in texts:
            spans = plain_spans(text)
            listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
            wanted.append((doc, *(sum(s[0] == k for s in spans) for k in pii.KINDS), hashlib.sha256(listed.encode()).hexdigest()))
            assert any(str(r.doc_id) == doc and set(filter(None, listed.split(","))) <= set(r.spans.split(",")) for r in found)
        assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found) == sorted(wanted)
    assert pii.find(no_docs).collect() == []


def test_classifier_learns_from_votes(spark):
    rng = random.Random(4)

    def card(valid):
        while True:
            digits = "4" + "".join(rng.choice("0123456789") for _ in range(14 if valid else 15))
            for d in "0123456789" if valid else [""]:
                if luhn(digits + d) == valid:
                    return digits + d

    texts = [f"call phone +1 555 555 {rng.randint(1000, 9999)} now" for _ in range(80)] + [f"phone (555) 555-{rng.randint(1000, 9999)} now" for _ in range(80)]
    texts += [f"paid by card {card(True)}" for _ in range(80)] + [f"order {card(False)} came" for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    assert all(found[i].spans.startswith("phone:11:") for i in range(80))
    assert all(found[i].spans.startswith("card:13:29") and found[i].n_card == 1 for i in range(160, 240))
    assert all(found[i].spans == "" for i in range(240, 320))


def test_redact(awkward, spark):
    docs = spark.createDataFrame([(1, "write to a.b@c.org, 10.0.0.1 or +1 555 555 1234"), (2, None), (3, "")], "doc_id long, text string").withColumn("id", F.lit(1))
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean == {1: "write to <email>, <ip> or <phone>", 2: None, 3: ""}
    assert pii.redact(awkward).columns == awkward.columns
    assert pii.redact(awkward).count() == awkward.count()

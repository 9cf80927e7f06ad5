"""Ranked lexical search against a plain count of terms; awkward documents and items."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tellerlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k):
    counts = [(i, Counter(found), len(found)) for i, text in docs if (found := terms(text))]
    n_docs, all_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, held in wanted.items():
        scored = []
        for i, c, n in counts:
            m = 100 - 50 + (50 * n * n_docs) // all_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in held if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


ITEMS = [
    (1, "The anea of THION, ered-hand"), (2, "é ñ ü ça words"), (2, "one two reing"), (3, None), (4, ""), (5, "..."), (6, "nothing of this occurs zzzz"),
    (None, "hand wher"), (7, "the the the"), (8, "ＡＢ １２ odd endoftext"), (9, "Ünter éA \U0001f600x reinga reinger"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit("clash") for c in ("item", "term", "id", "doc_id", "score")})


@pytest.mark.parametrize(("k", "block_bytes"), [(50, lexical.BLOCK_BYTES), (3, 300)])
def test_equals_brute_force(awkward, items, k, block_bytes):
    docs = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    found = lexical.rank(awkward.repartition(5), items, k=k, block_bytes=block_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, ITEMS, k)


def test_ties_over_many_tasks_and_a_small_buffer(spark, monkeypatch):
    rng = random.Random(3)
    docs = [(i, rng.choice(["the hand", "the hand the", "of", "hand of the anea"])) for i in range(400)]
    found = lexical.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(ITEMS, "item_id long, text string"), k=9)
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, ITEMS, 9)


def test_best_keeps_the_first_of_ties_when_cut_often():
    import numpy as np

    rng = np.random.default_rng(4)
    scores, ids = rng.integers(0, 4, (500, 3)), rng.permutation(500)
    best = lexical.Best(3, 5)
    for at in range(0, 500, 10):
        best.add(ids[at : at + 10], np.zeros(10, bool), scores[at : at + 10])
        best.cut()
    item, score, _, found = best.kept
    for i in range(3):
        wanted = sorted((-s, d) for s, d in zip(scores[:, i].tolist(), ids.tolist(), strict=True) if s > 0)[:5]
        assert [(-s, d) for s, d in zip(score[item == i].tolist(), found[item == i].tolist(), strict=True)] == wanted


def test_empty_tables(no_docs, awkward, items):
    assert lexical.rank(no_docs, items).count() == 0
    assert lexical.rank(awkward, items.limit(0)).count() == 0
    assert lexical.rank(awkward, items.filter("item_id in (3, 4, 5)")).count() == 0


def test_terms_of_bytes():
    text = "Ab-c é\x00Ñx9 \U0001f600\x7f!z"
    assert lexical.n_terms(lexical.guarded(text.encode())) == len(terms(text)) == 6
    assert lexical.guarded(text.encode()).split() == [t.encode() for t in terms(text)]

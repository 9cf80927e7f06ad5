"""Line field: exact marginals, held-out accuracy, awkward input."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerlake.llm import quality

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    size = np.array([1, 4, 3, 6])
    begin = np.r_[0, np.cumsum(size)[:-1]]
    score, turn = rng.normal(size=size.sum()), rng.normal(size=(2, 2))
    good, turns = quality.marginals(score, turn, begin, size)
    wanted_turns = np.zeros((2, 2))
    for b, n in zip(begin, size, strict=True):
        total, marks, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            weight = np.exp(sum(score[b + i] * labels[i] for i in range(n)) + sum(turn[labels[i], labels[i + 1]] for i in range(n - 1)))
            total += weight
            marks += weight * np.array(labels)
            for i in range(n - 1):
                pairs[labels[i], labels[i + 1]] += weight
        assert np.allclose(good[b : b + n], marks / total)
        wanted_turns += pairs / total
    assert np.allclose(turns, wanted_turns)


def test_neighbours_stay_within_a_document():
    x = quality.with_neighbours(np.arange(1, 6, dtype=np.float32).reshape(-1, 1), np.array([0, 2]))
    assert x.tolist() == [[1, 0, 2], [2, 1, 0], [3, 0, 4], [4, 3, 5], [5, 4, 0]]


@pytest.fixture(scope="module")
def scores(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classify(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(found) == docs.count()
    return found


def test_held_out_accuracy(scores):
    own = [r for r in scores if r.held_out and r.quality is not None]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scores)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scores)
    good, bad = ([r.score for r in own if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r.predicted == r.quality for r in own]) > 0.95


def test_awkward_documents(spark, awkward, no_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = quality.classify(awkward, labels.withColumn("text", F.lit("x"))).collect()
    assert len(found) == awkward.count()
    assert all(r.score is not None and 0 <= r.score <= 1 for r in found)
    assert not any(r.held_out for r in found if r.doc_id is None)
    assert quality.classify(no_docs, labels).collect() == []
    none = quality.classify(awkward, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    one = quality.classify(awkward, spark.createDataFrame([(4, 1), (5, None), (6, 7)], "doc_id long, quality int")).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.9
    twice = [quality.classify(awkward, labels).orderBy("doc_id", "score").collect() for _ in range(2)]
    assert twice[0] == twice[1]

"""Clustering with approximations against plain distances; bounds; awkward vectors."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerlake.llm import vafile

NAN, INF = float("nan"), float("inf")
SHOWN = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(rows, k, rounds, width, scale):
    kept = [(i, [min(max(math.floor(scale * x), -(2**26)), 2**26) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    started = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in started[:k]]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(members[n]) for x in zip(*members[n], strict=True)] if n in members else c for n, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {}
    for _, d, n in found:
        inertia[n] = inertia.get(n, 0) + d
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in found), key=str)


def table_of(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.withColumns({c: F.lit("clash") for c in ("v", "cells", "cluster", "distance", "rank", "dimension", "n", "id")})


@pytest.mark.parametrize(("scale", "k", "spread"), [(64, 16, 0.2), (64, 5, 3.0), (2, 8, 1.0), (1000, 16, 1.0)])
def test_equals_brute_force(spark, scale, k, spread):
    rng = np.random.default_rng(int(scale) + k)
    centres = rng.normal(size=(6, 8))
    values = centres[rng.integers(0, 6, 300)] + spread * rng.normal(size=(300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (900, None), (901, [1.0] * 7), (902, [NAN] * 8), (903, [None] + [1.0] * 7), (904, [INF] * 8), (905, []), (906, [100.0] + [0.0] * 7)]
    found = vafile.cluster(table_of(spark, rows).repartition(3), k=k, width=8, scale=scale)
    assert sorted(map(tuple, found.select(*SHOWN).collect()), key=str) == brute(rows, k, 3, 8, scale)


def test_separate_groups_are_not_fetched(spark):
    rng = np.random.default_rng(9)
    centres = (40 * rng.normal(size=(4, 8))).astype(int)
    v = np.repeat(centres, 60, axis=0) + rng.integers(-1, 2, (240, 8))
    edges = vafile.grid(spark.createDataFrame([(x.tolist(),) for x in v], "v array<int>"), 8)
    cells = np.stack([np.searchsorted(edges[d, 1:-1], v[:, d], side="right") for d in range(8)], axis=1)
    number, fetched = vafile.Bounds(centres, edges).nearest(cells, lambda at: v[at])
    assert not fetched.any() and (number == np.repeat(np.arange(4), 60)).all()


def test_bounds_hold():
    rng = np.random.default_rng(7)
    edges = np.sort(rng.integers(-50, 50, (6, vafile.CELLS + 1)), axis=1)
    v = np.stack([rng.integers(e[0], max(e[-1], e[0] + 1), 200) for e in edges], axis=1)
    cells = np.stack([np.searchsorted(edges[d, 1:-1], v[:, d], side="right") for d in range(6)], axis=1)
    centroids = rng.integers(-60, 60, (5, 6))
    bounds = vafile.Bounds(centroids, edges)
    least, most = np.split(bounds.table[bounds.rows + cells].sum(axis=1), 2, axis=1)
    exact = ((v[:, None] - centroids) ** 2).sum(axis=2)
    assert (least <= exact).all() and (exact <= most).all()
    assert (bounds.nearest(cells, lambda at: v[at])[0] == exact.argmin(axis=1)).all()


def test_few_and_extreme_vectors(spark):
    rows = [(1, [1e30, -1e30]), (2, [0.0, 0.0]), (3, [-1e300, 1e300])]
    for some in (rows, rows[:1], rows[1:2] * 20):
        found = vafile.cluster(table_of(spark, some), k=16, width=2)
        assert sorted(map(tuple, found.select(*SHOWN).collect()), key=str) == brute(some, 16, 3, 2, 64)


def test_no_vectors(spark):
    df = table_of(spark, [(1, None), (None, [0.0] * 64)])
    assert vafile.cluster(df.filter("vec_id = 1")).count() == 0
    assert vafile.cluster(df.limit(0)).select(*SHOWN).count() == 0
    assert vafile.cluster(df).count() == 0  # no vector with an id can start a centroid

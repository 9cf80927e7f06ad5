"""Exact search and threshold links against plain matrix products; awkward input."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerlake.llm import covertree, search

NAN, INF = float("nan"), float("inf")


def vectors():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(120, 12))
    near = np.concatenate([base[:10], base[:40] + 0.03 * rng.normal(size=(40, 12)), base[:1] + 0.001 * rng.normal(size=(60, 12)), -base[:5]])
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near]))]
    return rows + [(1000, None), (1001, [0.0] * 12), (1002, [NAN] + [1.0] * 11), (1050, [INF] * 12), (1051, [None, *([1.0] * 11)]), (1052, []), (None, [1.0] * 12), (1100, [1.0] * 5), (1150, [1e30] * 12)]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame(vectors(), "vec_id long, embedding array<double>")
    return df.withColumns({c: F.lit("clash") for c in ("id", "v", "cell", "shard", "query", "score", "label", "near")})


def usable(rows, zero):
    out = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    return [(i, np.pad(np.array(v, float), (0, 12 - len(v)))) for i, v in out if zero or any(v)]


def test_search_equals_brute_force(table):
    rows = [(i, [int(np.clip(np.floor(256 * x), -(2**63), 2**63 - 1)) for x in v]) for i, v in usable(vectors(), True)]
    wanted = []
    for q, a in rows:
        if q % 50 == 0:
            scored = sorted((-min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1), i) for i, b in rows if i != q)
            wanted += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    for shard, block in ((2048, 512), (30, 2)):
        found = search.top_k(table, F.col("id") % 50 == 0, shard_rows=shard, block_rows=block).collect()
        assert sorted(map(tuple, found)) == sorted(wanted)


@pytest.mark.parametrize("scale", [4, 256, 10**6, 10**9])
def test_search_of_ordinary_numbers(spark, scale):
    rng = np.random.default_rng(2)
    values = np.where(rng.random((300, 20)) < 0.5, 0, rng.normal(size=(300, 20)))  # many ties at a small scale
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)] + [(0, values[0].tolist())], "vec_id long, embedding array<double>")
    whole = [[int(x) for x in row] for row in np.floor(scale * values)]
    wanted = []
    for q in range(0, 300, 50):
        scored = sorted((-sum(x * y for x, y in zip(whole[q], b)), i) for i, b in enumerate(whole) if i != q)
        wanted += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert sorted(map(tuple, search.top_k(df, F.col("id") % 50 == 0, scale=scale, shard_rows=64).collect())) == wanted


def test_search_of_few_and_none(spark, table):
    two = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, search.top_k(two, F.col("id") % 50 == 0).collect())) == [(0, 1, 50, 256 * 512), (50, 1, 0, 256 * 512)]
    assert search.top_k(table.limit(0), F.col("id") % 50 == 0).collect() == []
    assert search.top_k(two.filter("vec_id = 0"), F.col("id") % 50 == 0).collect() == []


def test_unlike_vectors_of_one_id_are_ranked_each(spark):
    rows = [(0, [1.0]), *[(1, [10.0 + i]) for i in range(6)], (2, [9.0]), (3, [14.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    wanted = [(0, 1, 1, 15), (0, 2, 1, 14), (0, 3, 3, 14), (0, 4, 1, 13), (0, 5, 1, 12)]
    for shard in (2048, 2):
        assert sorted(map(tuple, search.top_k(df, F.col("id") == 0, scale=1, shard_rows=shard).collect())) == wanted


def brute_links(rows, cosine=0.9):
    good = usable(rows, False)
    scaled = np.array([v / np.abs(v).max() for _, v in good])
    unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    ids = [i for i, _ in good]
    label = np.array(ids)
    while True:
        now = np.array([min(label[i], label[linked[i]].min(initial=label[i])) for i in range(len(ids))])
        if (now == label).all():
            return {i: (int(n), int(r)) for i, n, r in zip(ids, linked.sum(axis=1), label, strict=True)}
        label = now


@pytest.mark.parametrize(("shard", "pivots"), [(2048, 64), (40, 4), (16, 1)])
def test_links_equal_brute_force(table, shard, pivots):
    wanted = brute_links(vectors())
    found = covertree.threshold_links(table, shard_rows=shard, pivots=pivots).collect()
    assert len(found) == len(vectors())
    for r in found:
        n, root = wanted.get(r.vec_id, (0, r.vec_id))
        assert (r.n_links, r.component_id, r.kept) == (n, root, r.vec_id == root)


def test_clusters_at_every_scale(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 8))
    parts = [c + s * rng.normal(size=(60, 8)) for c, s in zip(centre, (0, 0.01, 0.05, 0.15, 0.4, 1.0), strict=True)]
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(360), np.concatenate(parts), strict=True)]
    wanted = {i: x for i, x in brute_links([(i, np.array(v)) for i, v in [(i, v + [0.0] * 4) for i, v in rows]]).items()}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard in (2048, 50):
        found = covertree.threshold_links(df, shard_rows=shard, pivots=5).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in found} == wanted


def dense(rng, n, spread, width=16):
    return covertree.units(rng.normal(size=(1, width)) + spread * rng.normal(size=(n, width)))


@pytest.mark.parametrize("opened", [1 << 20, 5000])
def test_traversal_holds_few_pairs_at_a_time(monkeypatch, opened):
    """Where nearly every pair must be opened, results do not depend on the size of the portions, and none is much larger."""
    rng, sizes, inner = np.random.default_rng(9), [], covertree.near_pairs
    monkeypatch.setattr(covertree, "OPENED", opened)
    monkeypatch.setattr(covertree, "BLOCK", 64)
    monkeypatch.setattr(covertree, "near_pairs", lambda a, b, level, i, j, radius: sizes.append(len(i)) or inner(a, b, level, i, j, radius))
    one, two = dense(rng, 700, 0.3), dense(rng, 500, 0.3)
    two[:40] = one[:40]
    a, b = (covertree.Tree(x, covertree.tree(x.astype(np.float32))) for x in (one, two))
    linked = one @ two.T >= 0.9
    links_a, links_b, edges = covertree.dual_traversal(a, b, 0.9)
    assert linked.any() and (links_a == linked.sum(axis=1)).all() and (links_b == linked.sum(axis=0)).all()
    root = covertree.joined(1200, edges)
    assert (root == covertree.joined(1200, [(i, j + 700) for i, j in [np.nonzero(linked)]])).all()
    own = one @ one.T >= 0.9
    np.fill_diagonal(own, False)
    assert (covertree.dual_traversal(a, a, 0.9)[0] == own.sum(axis=1)).all()
    assert max(sizes) <= opened + 64 * 64


def test_far_vectors_are_ruled_out_by_block():
    """Vectors without structure: few pairs are looked at one by one, and shards are so large that each meets few others."""
    rng = np.random.default_rng(10)
    a, b = (covertree.Tree(x, covertree.tree(x.astype(np.float32))) for x in (covertree.units(rng.normal(size=(600, 64))) for _ in "ab"))
    opened = sum(len(x) for x, _, _ in covertree.near_pairs(a, b, 0, np.array([0]), np.array([0]), float(np.sqrt(0.2))))
    assert opened < 600 * 600 // 100 and covertree.SHARD_ROWS >= 8192


def test_levels_are_nested_and_cover():
    rng = np.random.default_rng(4)
    unit = covertree.units(np.concatenate([rng.normal(size=(80, 3)), np.repeat(rng.normal(size=(1, 3)), 20, axis=0)]))
    levels = covertree.tree(unit)
    for radius, up, low in zip(covertree.RADII, levels, levels[1:], strict=False):
        assert (up[low] == up).all() and (low[low] == low).all()
        assert np.linalg.norm(unit - unit[low], axis=1).max() <= radius + 1e-6


def test_no_vectors(table):
    assert covertree.threshold_links(table.limit(0)).collect() == []
    assert covertree.threshold_links(table.filter("vec_id = 1001")).collect()[0][1:] == (0, 1001, True)

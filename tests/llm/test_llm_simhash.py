"""SimHash: fingerprints and components against plain loops, pigeonhole shards, awkward input."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tellerlake.llm import simhash
from tellerlake.llm.components import components


def plain_fingerprint(text, width=3):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, nodes):
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def near(values, radius):
    return [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= radius]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def random_fingerprints(rng, n):
    values = {rng.getrandbits(64) for _ in range(n)}
    for v in list(values)[: n // 2]:
        for _ in range(rng.randint(1, 4)):
            w = v
            for b in rng.sample(range(64), rng.randint(1, 5)):
                w ^= 1 << b
            values.add(w)
    return sorted(values)


def test_fingerprints(monkeypatch):
    rng = random.Random(1)
    texts = ["", " ", "One", "one TWO", "É é A", " ".join(rng.choice("abcdef") for _ in range(2000)), "a\x1cb\x0bc\x0cd e"]
    for size in (1 << 20, 7):
        monkeypatch.setattr(simhash, "BLOCK_BYTES", size)
        for text in texts:
            for width in (1, 3, 5):
                assert simhash.fingerprint(text, width) == plain_fingerprint(text, width)


def test_tree_finds_all_pairs():
    rng = random.Random(2)
    values = np.array(random_fingerprints(rng, 150), np.uint64)
    pairs = {frozenset(p) for p in simhash.tree_links(values, 3)}
    assert {frozenset((int(values[a]), int(values[b]))) for a, b in map(tuple, pairs)} == {frozenset(p) for p in near([int(v) for v in values], 3)}


@pytest.mark.parametrize("limit", [4096, 2])
def test_links_connect_the_same(spark, limit):
    values = random_fingerprints(random.Random(3), 200)
    base = values[0]
    values = sorted(set(values) | {base ^ (k << 40) for k in range(40)})  # one crowded shard
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    found = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(df, 3, limit).collect()]
    assert plain_components(found, values) == plain_components(near(values, 3), values)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(50)] + [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(70)]
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    found = components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    assert {r.node: r.root for r in found} == {n: r for n, r in plain_components(edges, {n for e in edges for n in e}).items() if n in nodes}
    assert len(found) == len(nodes)
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").collect() == []


def test_awkward_documents(awkward, no_docs):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in awkward.select("doc_id", "text").collect()]
    fps = sorted({f for _, f in rows})
    root = plain_components(near(fps, 3), fps)
    least = {}
    for doc, fp in rows:
        if doc is not None:
            least[root[fp]] = min(doc, least.get(root[fp], doc))
    found = simhash.near_duplicates(awkward).collect()
    key = lambda t: tuple(map(str, t))
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=key) == sorted(((d, f"{f:016x}", least.get(root[f])) for d, f in rows), key=key)
    assert simhash.near_duplicates(no_docs).collect() == []
    kept = simhash.keep_first(awkward)
    assert kept.columns == awkward.columns
    assert sorted(root[plain_fingerprint(r.text)] for r in kept.collect()) == sorted(set(root.values()))
    assert simhash.keep_first(no_docs).collect() == []

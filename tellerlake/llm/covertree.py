"""Pairs of vectors with cosine at or above a threshold, by dual traversal of cover trees.

Unit vectors with cosine c are sqrt(2 - 2c) apart, so the pairs are those within a radius. Vectors go
to the nearest of a bounded number of pivots, pivots' groups are joined or cut by a hash to shards of a
bounded size, and shards are paired unless their pivots prove that they are too far apart. A shard's
tree has nested levels of centres with halving radii; every node knows the farthest vector below it.
Two trees are traversed together, level by level: node pairs too far apart for their covering
radii go, pairs near enough for all vectors below them count as linked without being opened, the
others are opened, in portions, so that few of them wait; at the leaves the cosine itself decides. So groups of copies cost a few
node pairs, and no list of all their pairs is ever made. Each pair of shards gives the number of links
of a vector and one vector that it is connected with; components follow from those.

The pivots are a bounded sample; they only steer where vectors go, results do not depend on them.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows without an id,
link with nothing (a null id has a null component and is kept); vectors of other lengths count as filled up with zeros;
repeated rows are vectors of their own that link with each other, and an id's links are the sum over
its rows; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.common import picked
from tellerlake.llm.components import components
from tellerlake.llm.search import padded
from tellerlake.session import settle

PIVOTS = 64
SHARD_ROWS = 8192
# Small tables have smaller shards, so that there are about as many as this; vectors meet in pairs of shards.
SHARDS, LEAST_ROWS = 8, 2048
RADII = (0.5, 0.25, 0.125, 0.0625)  # nodes of radius 1 would rule out no other: unit vectors are at most 2 apart
ROUNDING = 1e-5
BLOCK = 512
OPENED = 1 << 20


def units(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares of very large or small numbers would be lost
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def net(points: np.ndarray, radius: float) -> np.ndarray:
    """For each point the position of its centre: points become centres if no centre lies within ``radius``.

    The first point is a centre. Inner products stand for distances: near means large.
    """
    least, n = 1 - radius * radius / 2, len(points)
    centre = np.full(n, -1)
    chosen: list[int] = []
    for first in range(0, n, BLOCK):
        own = points[first : first + BLOCK]
        if chosen:
            near = own @ points[chosen].T
            best = near.argmax(axis=1)
            within = near[np.arange(len(own)), best] >= least
            centre[first : first + BLOCK][within] = np.array(chosen)[best[within]]
        open_ = np.flatnonzero(centre[first : first + BLOCK] < 0)
        among = own[open_] @ own[open_].T >= least
        free = np.ones(len(open_), dtype=bool)
        for i in range(len(open_)):
            if free[i]:
                member = free & among[i]
                member[:i] = False
                member[i] = True
                centre[first + open_[member]] = first + open_[i]
                free[member] = False
                chosen.append(int(first + open_[i]))
    return centre


def tree(points: np.ndarray) -> np.ndarray:
    """Levels x points: the centre of each point on each level; the first level has one node, the last the points themselves."""
    levels = [np.zeros(len(points), dtype=np.int64)]
    for radius in RADII:
        last, now = levels[-1], levels[-1].copy()
        order = np.argsort(last, kind="stable")
        cuts = np.flatnonzero(np.diff(last[order])) + 1
        for members in np.split(order, cuts):
            if len(members) > 1:
                centre = last[members[0]]
                members = np.r_[centre, members[members != centre]]  # the node's own centre stays one: levels are nested
                now[members] = members[net(points[members], radius)]
        levels.append(now)
    levels.append(np.arange(len(points)))
    return np.stack(levels)


class Tree:
    """A shard's vectors with their nodes: per level the centres, covering radii, numbers of vectors, and children."""

    def __init__(self, unit: np.ndarray, levels: np.ndarray):
        self.unit, self.near = unit, unit.astype(np.float32)
        self.centre, self.node = [], []
        for path in levels:
            centre, node = np.unique(path, return_inverse=True)
            self.centre.append(centre)
            self.node.append(node)
        self.cover, self.count, self.children, self.bounds = [], [], [], []
        for level, node in enumerate(self.node):
            far = np.zeros(len(self.centre[level]))
            gap = 2 - 2 * np.einsum("ij,ij->i", unit, unit[self.centre[level][node]])
            np.maximum.at(far, node, np.sqrt(np.maximum(gap, 0)))
            self.cover.append(far)
            self.count.append(np.bincount(node))
            if level + 1 < len(self.node):
                parent = node[self.centre[level + 1]]  # a centre of the next level lies below its parent
                self.children.append(np.argsort(parent, kind="stable"))
                self.bounds.append(np.r_[0, np.cumsum(np.bincount(parent, minlength=len(far)))])


def near_pairs(a: Tree, b: Tree, level: int, i: np.ndarray, j: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Opens node pairs: (i, j, inner product) of child pairs that may hold vectors within ``radius``."""
    low = level + 1

    def least(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The inner product at the largest distance that covering radii allow."""
        reach = (a.cover[low][x] + b.cover[low][y]).astype(np.float32)
        reach += radius
        reach *= reach
        reach *= -0.5
        reach += 1 - ROUNDING
        return reach

    size_a, size_b = np.diff(a.bounds[level])[i], np.diff(b.bounds[level])[j]
    big = size_a * size_b > BLOCK
    for x, y in zip(i[big], j[big], strict=True):
        own = a.children[level][a.bounds[level][x] : a.bounds[level][x + 1]]
        other = b.children[level][b.bounds[level][y] : b.bounds[level][y + 1]]
        # By covering radius, so that one bound for a whole block is near to those of its pairs.
        own, other = (z[np.argsort(t.cover[low][z], kind="stable")] for t, z in ((a, own), (b, other)))
        right = b.near[b.centre[low][other]]
        for k in range(0, len(own), BLOCK):
            left, last = a.near[a.centre[low][own[k : k + BLOCK]]], own[k : k + BLOCK][-1:]
            for m in range(0, len(other), BLOCK):
                product = left @ right[m : m + BLOCK].T
                loose = np.flatnonzero(product >= least(last, other[m : m + BLOCK][-1:])[0])
                r, c = np.divmod(loose, product.shape[1])
                found, one, two = product.ravel()[loose], own[k + r], other[m + c]
                keep = found >= least(one, two)
                yield one[keep], two[keep], found[keep]
    i, j, size_a, size_b = i[~big], j[~big], size_a[~big], size_b[~big]
    pairs = np.cumsum(size_a * size_b)
    begin = 0
    while begin < len(i):
        end = max(begin + 1, int(np.searchsorted(pairs, (pairs[begin - 1] if begin else 0) + OPENED)))
        n = (size_a * size_b)[begin:end]
        which = np.repeat(np.arange(begin, end), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        x = a.children[level][a.bounds[level][i[which]] + nth // size_b[which]]
        y = b.children[level][b.bounds[level][j[which]] + nth % size_b[which]]
        product = np.einsum("ij,ij->i", a.near[a.centre[low][x]], b.near[b.centre[low][y]])
        keep = product >= least(x, y)
        yield x[keep], y[keep], product[keep]
        begin = end


def dual_traversal(a: Tree, b: Tree, cosine: float) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Links of each vector of ``a`` and of ``b``, and edges (positions, those of ``b`` after those of ``a``) that connect the same.

    For one and the same tree, links with itself are left out and both directions are walked.
    """
    same, radius, n = a is b, float(np.sqrt(2 - 2 * cosine)), len(a.unit)
    shift = 0 if same else n
    links_a, links_b, edges = np.zeros(n, np.int64), np.zeros(len(b.unit), np.int64), []
    depth, held = len(a.node) - 1, 0

    def connect(x: np.ndarray, y: np.ndarray) -> None:
        nonlocal held
        edges.append((x, y))
        held += len(x)
        if held > OPENED:  # of what is connected so far one edge a vector is kept
            root = joined(shift + len(b.unit), edges)
            edges[:], held = [(np.arange(len(root)), root)], 0

    def walk(level: int, i: np.ndarray, j: np.ndarray) -> None:
        """Node pairs are opened below in portions, so that only a bounded number of them waits on each level."""
        low = level + 1
        opened: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        sums_a, sums_b = np.zeros(len(a.centre[low]), np.int64), np.zeros(len(b.centre[low]), np.int64)
        for x, y, product in near_pairs(a, b, level, i, j, radius):
            if low == depth:  # vectors themselves
                exact = np.einsum("ij,ij->i", a.unit[x], b.unit[y]) >= cosine
                if same:
                    exact &= x != y
                inside = exact
            else:
                apart = np.sqrt(np.maximum(2 - 2 * product.astype(np.float64), 0))
                reach = a.cover[low][x] + b.cover[low][y]
                inside = apart + reach <= radius - 0.01
                maybe = ~inside & (apart - reach <= radius + 0.01)
                opened.append((x[maybe], y[maybe]))
                waiting += len(opened[-1][0])
            x, y = x[inside], y[inside]
            if len(x):
                np.add.at(sums_a, x, b.count[low][y])
                np.add.at(sums_b, y, a.count[low][x])
                if same and low < depth:
                    np.subtract.at(sums_a, x[x == y], 1)
                connect(a.centre[low][x], b.centre[low][y] + shift)
            if waiting > OPENED:
                walk(low, *(np.concatenate(z) for z in zip(*opened, strict=True)))
                opened, waiting = [], 0
        for t, sums, links, move in ((a, sums_a, links_a, 0), (b, sums_b, links_b, shift)):
            linked = sums > 0
            if linked.any():  # all vectors below a linked node are linked with the other node's vectors, so with its own centre's too
                links += sums[t.node[low]]
                at = np.flatnonzero(linked[t.node[low]])
                connect(at + move, t.centre[low][t.node[low][at]] + move)
        if waiting:
            walk(low, *(np.concatenate(z) for z in zip(*opened, strict=True)))

    walk(0, np.array([0]), np.array([0]))
    return links_a, links_b, edges


def joined(n: int, edges: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least position that each position is connected with."""
    root = np.arange(n)
    if not edges:
        return root
    a, b = (np.concatenate(z) for z in zip(*edges, strict=True))
    while len(a):
        x, y = root[a], root[b]
        differ = x != y
        if not differ.any():
            break
        a, b = a[differ], b[differ]
        np.minimum.at(root, np.maximum(x[differ], y[differ]), np.minimum(x[differ], y[differ]))
        while (root[root] != root).any():
            root = root[root]
    return root


def with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, v, pivot, apart): the nearest pivot and the distance to it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = max([pivots.shape[1], *batch.column("v").value_lengths().to_pylist()])
            rows = units(padded(batch.column("v"), width))
            product = rows @ np.pad(pivots, ((0, 0), (0, width - pivots.shape[1]))).T
            best = product.argmax(axis=1)
            apart = np.sqrt(np.maximum(2 - 2 * product[np.arange(len(rows)), best], 0))
            columns = [batch.column("id"), batch.column("v"), pa.array(best.astype(np.int32)), pa.array(apart)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "pivot", "apart"])

    return vectors.mapInArrow(work, "id long, v array<double>, pivot int, apart double")


def partners(pivots: np.ndarray, counts: dict[int, int], reach: dict[int, float], shard_rows: int, radius: float) -> list[tuple[int, int, int, list[tuple[int, int]]]]:
    """(pivot, first shard, number of shards, runs of shards (first, number) that may hold vectors near to those of its shards)."""
    first, number, made, filled = {}, {}, 0, 0
    for p in sorted(counts):
        if counts[p] >= shard_rows // 2:
            number[p] = -(-counts[p] // shard_rows)
            first[p], made, filled = made + (filled > 0), made + (filled > 0) + number[p], 0
        else:  # small groups share a shard
            if filled and filled + counts[p] > shard_rows:
                made, filled = made + 1, 0
            first[p], number[p], filled = made, 1, filled + counts[p]
    gap = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
    out = []
    for p in sorted(counts):
        near: set[tuple[int, int]] = set()
        # All pivots that share a shard with p speak for that shard.
        mates = [q for q in counts if number[q] == 1 and number[p] == 1 and first[q] == first[p]] or [p]
        for q in counts:
            if any(gap[m, q] <= reach[m] + reach[q] + radius + ROUNDING for m in mates):
                near.add((first[q], number[q]))
        out.append((p, first[p], number[p], sorted(near)))
    return out


def pair_of_shards(cell: pa.Table, cosine: float) -> pa.Table:
    """Links and connections between the two shards of a cell (or within its one shard)."""
    shard, own = cell["shard"].to_numpy(), cell["id"].to_numpy()
    width = max(cell["v"].combine_chunks().value_lengths().to_pylist())
    unit, trees, at = units(padded(cell["v"], width)), [], []
    for s in np.unique(shard):
        rows = np.flatnonzero(shard == s)
        rows = rows[np.argsort(cell["place"].to_numpy()[rows])]
        trees.append(Tree(unit[rows], padded(cell["path"].take(pa.array(rows)), len(RADII) + 2).astype(np.int64).T))
        at.append(rows)
    ids = own[np.concatenate(at)]
    within = bool(cell["within"][0].as_py())
    if not within and len(trees) < 2:
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    else:
        links_a, links_b, edges = dual_traversal(trees[0], trees[0] if within else trees[1], cosine)
        links = links_a if within else np.r_[links_a, links_b]
        root = joined(len(ids), edges)
    linked = links > 0
    return pa.table({"id": ids[linked], "links": links[linked], "root": ids[root[linked]]})


def threshold_links(
    vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """id, n_links, component_id (the smallest id that links lead to) and kept (is that itself) of every row."""
    spark = vectors.sparkSession
    source = picked(vectors, id=id_col, v=vector_col).select(F.col("id").cast("long").alias("id"), F.transform("v", lambda x: x.cast("double")).alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    valid = source.filter(F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    sample = [r["v"] for r in valid.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()]
    nothing = spark.createDataFrame([], "id long, links long, root long")
    found = nothing if not sample else linked_shards(valid, sample, cosine, shard_rows)
    totals = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    roots = components(found.select("id", "root"), "id", "root").withColumnRenamed("node", "id")
    shown = source.select("id").join(totals, "id", "left").join(roots, "id", "left")
    component = F.coalesce("root", "id")
    return shown.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def linked_shards(valid: DataFrame, sample: list[list[float]], cosine: float, shard_rows: int) -> DataFrame:
    """(id, links, root) from each pair of shards."""
    spark, width = valid.sparkSession, max(map(len, sample))
    centres = units(np.array([r + [0.0] * (width - len(r)) for r in sample]))
    placed = settle(with_pivots(valid, centres), "nearest-pivots")
    seen = placed.groupBy("pivot").agg(F.count("*").alias("n"), F.max("apart").alias("far")).collect()  # at most a row per pivot
    counts, reach = {r["pivot"]: r["n"] for r in seen}, {r["pivot"]: r["far"] for r in seen}
    shard_rows = min(shard_rows, max(LEAST_ROWS, -(-sum(counts.values()) // SHARDS)))
    plan = partners(centres, counts, reach, shard_rows, float(np.sqrt(2 - 2 * cosine)))
    groups = F.broadcast(spark.createDataFrame([p[:3] for p in plan], "pivot int, first long, number long"))
    spread = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.col("number"))
    sharded = placed.join(groups, "pivot").select("id", "v", "pivot", (F.col("first") + spread).alias("shard"))

    def grow(rows: pa.Table) -> pa.Table:
        unit = units(padded(rows["v"], max(rows["v"].combine_chunks().value_lengths().to_pylist())))
        path = tree(unit.astype(np.float32)).T
        lists = pa.array(list(path.astype(np.int32)), pa.list_(pa.int32()))
        return pa.table({**{c: rows[c] for c in ("id", "v", "pivot", "shard")}, "place": pa.array(np.arange(len(path), dtype=np.int32)), "path": lists})

    grown = settle(sharded.groupBy("shard").applyInArrow(grow, "id long, v array<double>, pivot int, shard long, place int, path array<int>"), "cover-trees")
    runs = F.broadcast(spark.createDataFrame([(p[0], p[3]) for p in plan], "pivot int, near array<struct<first:long,number:long>>"))
    meeting = grown.join(runs, "pivot").withColumn("run", F.explode("near")).drop("near")
    meeting = meeting.withColumn("other", F.explode(F.sequence("run.first", F.col("run.first") + F.col("run.number") - 1)))
    cells = meeting.select(
        "id", "v", "shard", "place", "path", (F.col("shard") == F.col("other")).alias("within"),
        F.least("shard", "other").alias("low"), F.greatest("shard", "other").alias("high"),
    )
    return settle(cells.groupBy("low", "high").applyInArrow(lambda rows: pair_of_shards(rows, cosine), "id long, links long, root long"), "cell-links")

"""Clustering around centroids with a vector-approximation file.

Vectors are whole numbers. Each component is also kept as a cell of six bits on a grid of its dimension:
equal cells over all but the outermost thousandths, and an open cell at either end, so that outliers widen
only the outer cells. Per round, tables
say for each dimension, cell and centroid how far a component in that cell can be from the centroid's
at least and at most. Sums of table entries give an interval of the distance to every centroid
from the cells alone. A centroid whose lower bound lies above the least upper bound cannot be nearest;
where one centroid is left the vector is not fetched, and where intervals overlap it is, and its
distances to just those centroids are worked out.

The sums of a round come from those of the round before: vectors that changed their cluster are fetched
and moved from one sum to the other, the others are not. The first round fetches all vectors for the
sums, the last one for the distances asked for.

Cells and vectors are columns of one written table. A Spark scan has no random access, so fetching
means decoding the vector from its row in the scan that also reads its cells; there is no join and no shuffle of
vectors. Each task sends 16 x 64 sums; the driver holds the centroids and the grid, nothing of the rows.

Defined results: vectors that are null, of another length, or hold null or non-finite components take
no part; rows without an id are clustered but never start a centroid; repeated rows count each; rows of
one id at the start are ordered by their vector. With fewer vectors than centroids there are as many centroids
as vectors; an empty table gives no rows. Components beyond 2**26 are drawn to it, so that distances fit 64 bits;
sums beyond 64 bits are drawn to the largest number. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.common import in_small, picked
from tellerlake.session import settle

BITS = 6
TAIL = 0.001
CELLS = 1 << BITS
REACH = 2**26
LONGEST = 2**63 - 1
ROWS = 512


def usable(vectors: DataFrame, id_col: str, vector_col: str, width: int, scale: int) -> DataFrame:
    """(vec_id, v): components as floor(scale * x); only vectors that take part."""
    source = picked(vectors, vec_id=id_col, v=vector_col).filter(F.size("v") == width)
    value = F.transform("v", lambda x: x.cast("double"))
    good = F.forall(value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    number = F.transform(value, lambda x: F.least(F.greatest(F.floor(F.least(F.greatest(x * float(scale), F.lit(-2.0**40)), F.lit(2.0**40))), F.lit(-REACH)), F.lit(REACH)).cast("int"))
    return source.filter(good).select(F.col("vec_id").cast("long").alias("vec_id"), number.alias("v"))


def grid(vectors: DataFrame, width: int) -> np.ndarray:
    """The edges of the cells of each dimension: a cell holds the numbers from its edge to below the next one."""
    cuts = [F.percentile_approx(F.col("v")[i], [TAIL, 1 - TAIL], 1000) for i in range(width)]
    ends = [F.array(F.min(F.col("v")[i]), F.max(F.col("v")[i])) for i in range(width)]
    found = vectors.agg(F.array(*cuts).alias("cuts"), F.array(*ends).alias("ends")).first()
    edges = np.empty((width, CELLS + 1), np.int64)
    for row, (low, high), (least, most) in zip(edges, found.cuts, found.ends, strict=True):
        step = -(-(high - low + 1) // (CELLS - 2))
        first = low - (step * (CELLS - 2) - (high - low + 1)) // 2
        row[1:-1] = first + step * np.arange(CELLS - 1)
        row[0], row[-1] = min(least, row[1]), max(most + 1, row[-2])
    return edges


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def approximated(batches: Iterator[pa.RecordBatch], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(vec_id, cells, v): a byte for each cell, the vector as 32-bit numbers."""
    for batch in in_small(batches, ROWS):
        v = matrix(batch.column("v"), len(edges))
        cells = np.stack([np.searchsorted(edges[d, 1:-1], v[:, d], side="right") for d in range(len(edges))], axis=1).astype(np.uint8)
        yield pa.RecordBatch.from_pydict({
            "vec_id": batch.column("vec_id"), "cells": pa.array([r.tobytes() for r in cells], pa.binary()), "v": pa.array([r.tobytes() for r in v.astype("<i4")], pa.binary()),
        })


class Bounds:
    """Tables of one set of centroids over a grid."""

    def __init__(self, centroids: np.ndarray, edges: np.ndarray):
        self.centroids = centroids
        low, high = edges[:, :-1], np.maximum(edges[:, 1:] - 1, edges[:, :-1])
        below, above = low[..., None] - centroids.T[:, None, :], centroids.T[:, None, :] - high[..., None]
        least = np.maximum(np.maximum(below, above), 0) ** 2
        most = np.maximum(np.abs(below), np.abs(above)) ** 2
        # A row per dimension and cell; columns: lower bounds of all centroids, then upper bounds.
        self.table = np.concatenate([least, most], axis=2).reshape(len(edges) * CELLS, -1)
        self.rows = np.arange(len(edges)) * CELLS

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """Which centroids can be nearest, by the cells alone."""
        interval = self.table[self.rows + cells].sum(axis=1)
        least, most = np.split(interval, 2, axis=1)
        return least <= most.min(axis=1, keepdims=True)

    def nearest(self, cells: np.ndarray, fetch) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid, the smaller one at ties, and whether the vector had to be fetched."""
        able = self.candidates(cells)
        number, several = able.argmax(axis=1), able.sum(axis=1) > 1
        at = np.flatnonzero(several)
        row, centroid = np.nonzero(able[at])
        distance = np.full((len(at), len(self.centroids)), LONGEST)
        distance[row, centroid] = ((fetch(at)[row] - self.centroids[centroid]) ** 2).sum(axis=1)
        number[at] = distance.argmin(axis=1)
        return number, several


class Rows:
    """A batch: cells are read for all rows, vectors for those asked for."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        self.cells = np.frombuffer(b"".join(batch.column("cells").to_pylist()), np.uint8).reshape(batch.num_rows, width).astype(np.int64)
        self.vectors, self.width = batch.column("v"), width

    def fetch(self, at: np.ndarray) -> np.ndarray:
        data = b"".join(self.vectors.take(pa.array(at)).to_pylist())
        return np.frombuffer(data, "<i4").reshape(len(at), self.width).astype(np.int64)


def moved(batches: Iterator[pa.RecordBatch], before: Bounds | None, now: Bounds) -> Iterator[pa.RecordBatch]:
    """(cluster, dimension, n): what the clusters win and lose against the round before; dimension -1 counts vectors."""
    k, width = now.centroids.shape
    change = np.zeros((k, width + 1), np.int64)
    for batch in in_small(batches, ROWS):
        rows = Rows(batch, width)
        new, _ = now.nearest(rows.cells, rows.fetch)
        old = before.nearest(rows.cells, rows.fetch)[0] if before else np.full(len(new), -1)
        at = np.flatnonzero(new != old)
        v = np.concatenate([np.ones((len(at), 1), np.int64), rows.fetch(at)], axis=1)
        np.add.at(change, new[at], v)
        if before:
            np.subtract.at(change, old[at], v)
    cluster, dimension = np.nonzero(change)
    yield pa.RecordBatch.from_pydict({"cluster": pa.array(cluster, pa.int32()), "dimension": pa.array(dimension - 1, pa.int32()), "n": pa.array(change[cluster, dimension], pa.int64())})


def assigned(batches: Iterator[pa.RecordBatch], now: Bounds) -> Iterator[pa.RecordBatch]:
    """(vec_id, cluster, distance, fetched)."""
    for batch in in_small(batches, ROWS):
        rows = Rows(batch, now.centroids.shape[1])
        number, several = now.nearest(rows.cells, rows.fetch)
        distance = ((rows.fetch(np.arange(batch.num_rows)) - now.centroids[number]) ** 2).sum(axis=1)
        yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "cluster": pa.array(number, pa.int32()), "distance": pa.array(distance, pa.int64()), "fetched": pa.array(several)})


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, and whether the cells left several centroids (fetched)."""
    whole = usable(vectors, id_col, vector_col, width, scale)
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    starts = whole.filter(F.col("vec_id").isNotNull()).withColumn("rank", rank).orderBy("rank", "v").limit(k).collect()
    shown = "vec_id long, cluster int, distance long, fetched boolean"
    if not starts:
        empty = "cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], f"{shown}, {empty}").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "fetched")
    edges = grid(whole, width)
    rows = settle(whole.mapInArrow(lambda b: approximated(b, edges), "vec_id long, cells binary, v binary"), "va-file")
    centroids = np.array([s.v for s in starts], np.int64)
    sums = [[0] * (width + 1) for _ in centroids]
    before = None
    for _ in range(rounds):
        now = Bounds(centroids, edges)
        changes = rows.select("cells", "v").mapInArrow(lambda b, old=before, new=now: moved(b, old, new), "cluster int, dimension int, n long")
        for r in changes.groupBy("cluster", "dimension").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect():
            sums[r.cluster][r.dimension + 1] += int(r.n)
        centroids = np.array([[x // n for x in total] if n else list(old) for (n, *total), old in zip(sums, centroids.tolist(), strict=True)], np.int64)
        before = now
    last = Bounds(centroids, edges)
    found = settle(rows.mapInArrow(lambda b: assigned(b, last), shown), "va-clusters")
    inertia = {r.cluster: int(r.n) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}
    hashes = {c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest() for c in inertia}

    def by_cluster(values: dict[int, object], kind: str):
        return F.create_map(*[x for c, value in values.items() for x in (F.lit(c), F.lit(value).cast(kind))])[F.col("cluster")]

    return found.select(
        "vec_id", "cluster", "distance", by_cluster({c: min(n, LONGEST) for c, n in inertia.items()}, "long").alias("cluster_inertia"),
        F.lit(min(sum(inertia.values()), LONGEST)).cast("long").alias("inertia"), by_cluster(hashes, "string").alias("centroid_sha256"), "fetched",
    )

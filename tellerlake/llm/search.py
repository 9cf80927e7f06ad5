"""Exact top-k search by inner product with MaxScore.

Vectors are whole numbers. A term is a dimension with a sign; its postings are the vectors whose
component there has that sign, so a query's terms can only add to a score, and components of the
other sign can only take away. Each shard of vectors answers each block of queries: query terms are
ordered by the most they can add; the weakest ones that together stay below the k-th best score so far
are non-essential. Postings of the essential terms are traversed, the others are probed only
for vectors that are still competitive. The best k of each shard are merged per query.

Shards and blocks have a bounded number of rows and are cut by a hash, so none is hot. Every query
meets every vector once, in the cell of its block and the vector's shard.

Defined results: vectors that are null, or hold null or non-finite components, or have no id, take no part; an
empty vector scores 0 with all; vectors of other lengths count as filled up with zeros; repeated
rows count once, unlike vectors of one id are ranked each; rows that share a query's id are its own and no candidates; ties go to the
smaller id; an empty table gives no rows. Components and scores beyond
64 bits are drawn to the nearest 64-bit number. Other columns are not read.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerlake.llm.common import picked
from tellerlake.session import settle

SHARD_ROWS = 2048
BLOCK_ROWS = 512
HEAD = 32
SEED_TERMS = 6
PROBES = 8


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): components as floor(scale * x); only vectors that take part, each once."""
    source = picked(vectors, id=id_col, v=vector_col).filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    value = F.transform("v", lambda x: x.cast("double"))
    usable = F.forall(value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    numbers = F.transform(value, lambda x: F.floor(x * float(scale)).cast("double"))
    return source.filter(usable).select(F.col("id").cast("long").alias("id"), numbers.alias("v")).distinct()


def padded(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


class Shard:
    """Postings of one shard: per dimension the components of all its vectors, the bounds and the vectors of most impact."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids = ids
        self.by_dimension = np.ascontiguousarray(rows.T)
        self.most = np.stack([np.maximum(self.by_dimension.max(axis=1, initial=0), 0), np.maximum(-self.by_dimension.min(axis=1, initial=0), 0)])
        n = min(HEAD, len(ids))
        ranked = np.argpartition(self.by_dimension, [n - 1, len(ids) - n], axis=1)
        self.heads = (ranked[:, len(ids) - n :], ranked[:, :n])

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the best k, better ones first."""
        others = self.ids != query_id
        sign = (query < 0).astype(int)
        bound = np.abs(query) * self.most[sign, np.arange(len(query))]
        order = np.argsort(bound, kind="stable")
        least = self.seed(query, order, sign, others, k)
        below = np.cumsum(bound[order])
        cut = int(np.searchsorted(below, least, side="left"))  # the sum of all before stays below `least`
        essential, rest = order[cut:], float(below[cut - 1]) if cut else 0.0
        score = query[essential] @ self.by_dimension[essential]
        alive = np.flatnonzero((score + rest >= least) & others)
        score = score[alive]
        for first in range(cut, 0, -PROBES):
            terms = order[max(0, first - PROBES) : first]
            score = score + query[terms] @ self.by_dimension[np.ix_(terms, alive)]
            rest = float(below[first - PROBES - 1]) if first > PROBES else 0.0
            if len(score) > k:
                least = max(least, np.partition(score, len(score) - k)[len(score) - k] - self.lost(bound, query, order, first - PROBES, sign))
            keep = score + rest >= least
            alive, score = alive[keep], score[keep]
        best = np.lexsort((self.ids[alive], -score))[:k]
        return alive[best], score[best]

    def lost(self, bound: np.ndarray, query: np.ndarray, order: np.ndarray, left: int, sign: np.ndarray) -> float:
        """The most that the terms not yet probed can take away from a score."""
        terms = order[: max(left, 0)]
        return float((np.abs(query[terms]) * self.most[1 - sign[terms], terms]).sum())

    def seed(self, query: np.ndarray, order: np.ndarray, sign: np.ndarray, others: np.ndarray, k: int) -> float:
        """The k-th best score among the vectors of most impact in the strongest terms; no score is left out by it."""
        strongest = order[::-1][:SEED_TERMS]
        if not len(strongest):
            return -np.inf
        seeds = np.unique(np.concatenate([self.heads[sign[t]][t] for t in strongest]))
        seeds = seeds[others[seeds]]
        if len(seeds) < k:
            return -np.inf
        return np.partition(query @ self.by_dimension[:, seeds], len(seeds) - k)[len(seeds) - k]


def arithmetic(rows: np.ndarray) -> np.ndarray:
    """The rows in a type that computes their inner products without rounding."""
    most = np.abs(rows).max(initial=0)
    reach = rows.shape[1] * most * most
    if reach < 2**24:
        return rows.astype(np.float32)
    return rows if reach < 2**53 else np.array([[int(x) for x in row] for row in rows], dtype=object)


def exact_top(ids: np.ndarray, rows: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for numbers of any size."""
    at = np.flatnonzero(ids != query_id)
    scores = [min(max(int(x), -(2**63)), 2**63 - 1) for x in rows[at] @ query]
    best = sorted(range(len(at)), key=lambda i: (-scores[i], ids[at[i]]))[:k]
    return at[best], np.array([scores[i] for i in best], dtype=np.int64)


def answer(cell: pa.Table, k: int) -> pa.Table:
    """The best k vectors of a shard for each query of a block."""
    width = max(max(cell["v"].combine_chunks().value_lengths().to_pylist(), default=0), 1)
    ids, rows = cell["id"].to_numpy(), arithmetic(padded(cell["v"], width))
    is_query = cell["query"].to_numpy()
    shard_ids, shard_rows = ids[~is_query], rows[~is_query]
    out: list[list[np.ndarray]] = [[], [], []]
    if len(shard_ids):
        shard = None if rows.dtype == object else Shard(shard_ids, shard_rows)
        for query_id, query in zip(ids[is_query], rows[is_query], strict=True):
            at, score = shard.top(query_id, query, k) if shard else exact_top(shard_ids, shard_rows, query_id, query, k)
            for column, found in zip(out, (np.full(len(at), query_id), shard_ids[at], score.astype(np.int64)), strict=True):
                column.append(found)
    columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})


def top_k(
    vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``queries`` (a condition on the id, named id) holds, its best k others."""
    rows = settle(whole_numbers(vectors, id_col, vector_col, scale), "search-vectors")
    count = rows.agg(F.count("*").alias("n"), F.count_if(queries).alias("q")).first()
    shards, blocks = -(-count["n"] // shard_rows) or 1, -(-count["q"] // block_rows) or 1

    def dealt(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))

    everywhere = rows.withColumns({"shard": dealt(shards, 1), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "query": F.lit(False)})
    asked = rows.filter(queries).withColumns({"block": dealt(blocks, 2), "shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), "query": F.lit(True)})
    shown = ["id", "v", "query", (F.col("shard") * blocks + F.col("block")).cast("long").alias("cell")]
    cells = everywhere.select(*shown).unionByName(asked.select(*shown)).groupBy("cell")
    found = cells.applyInArrow(lambda table: answer(table, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

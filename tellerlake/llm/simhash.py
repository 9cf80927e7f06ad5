"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked within a Hamming radius by BK-trees.

Shards are cut by the pigeonhole principle: fingerprints at most three bits apart agree on one of
four blocks of their bits, and again on one of four blocks of the other bits, and so on. A tree
holds the fingerprints of one shard, and exactly the fingerprints that can match it are searched in
it. Shards with more than ``shard_limit`` fingerprints are cut once more by further blocks, down to
blocks that leave 2**21 possible fingerprints, so a tree is bounded without leaving a pair out.
Only distinct fingerprints are compared; a shard gives a spanning forest of its links, not all pairs.

Defined results: a null text is an empty one; texts without words have fingerprint zero and link
like any other; repeated rows get the same fingerprint; null ids get a fingerprint and the smallest
id of their group (null if there is none); an empty table gives no rows. Columns other than the id
and the text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerlake.llm.common import in_small, picked
from tellerlake.llm.components import components
from tellerlake.session import settle

SEED = 42
BLOCK_BYTES = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")
# Level by level: bits still free and the width of one of the four blocks (the last takes what is over).
LEVELS = ((64, 16), (48, 12), (36, 9), (27, 6))
ALWAYS = 2
SHARD_LIMIT = 4096


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits set."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    counts = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:  # sums of 255 bits fit a byte, which is added much faster
        counts += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: str, width: int = 3) -> int:
    """Bit set if set in over half of the hashes of the shingles of ``width`` lower-cased words (unsigned)."""
    from xxhash import xxh64_intdigest

    data = text.encode().lower()  # bytes: only A-Z
    counts, total, carried, at = np.zeros(64, dtype=np.int64), 0, [], 0
    while at < len(data):
        stop = SPACE.search(data, at + BLOCK_BYTES)
        end = stop.start() if stop else len(data)
        found = carried + data[at:end].split()
        at = end
        carried = found[max(0, len(found) - width + 1) :]
        if len(found) >= width:
            joined = b" ".join(found)
            ends = [e - 1 for e in accumulate(len(w) + 1 for w in found)]
            starts = [0, *(e + 1 for e in ends[:-1])]
            n = len(found) - width + 1
            hashes = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :])), dtype=np.uint64, count=n)
            for k in range(0, n, 1 << 16):
                counts += bit_counts(hashes[k : k + (1 << 16)])
            total += n
    if not total and carried:
        counts, total = bit_counts(np.array([xxh64_intdigest(b" ".join(carried), SEED)], dtype=np.uint64)), 1
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp): fp holds the 64 bits as a signed number."""
    source = picked(docs, id=id_col, text=text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small(batches, 1000):
            found = np.array([fingerprint(t.as_py() or "", width) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], names=["id", "fp"])

    return source.mapInArrow(work, T.StructType([T.StructField("id", source.schema["id"].dataType), T.StructField("fp", T.LongType())]))


def split_once(rows: DataFrame, level: int) -> DataFrame:
    """Each (key, fp, rest) four times: keyed by one block of the free bits as well."""
    free, width = LEVELS[level]

    def block(j: int) -> Column:
        low, own = width * j, width if j < 3 else free - 3 * width
        value = F.shiftrightunsigned("rest", low).bitwiseAND((1 << own) - 1)
        below = F.col("rest").bitwiseAND((1 << low) - 1)
        above = F.shiftleft(F.shiftrightunsigned("rest", low + own), low) if low + own < 64 else F.lit(0).cast("long")
        # A collision of two keys only joins two shards.
        return F.struct(F.xxhash64("key", F.lit(level), F.lit(j), value).alias("key"), below.bitwiseOR(above).alias("rest"))

    return rows.select("fp", F.explode(F.array(*[block(j) for j in range(4)])).alias("b")).select("b.key", "fp", "b.rest")


def shards(distinct: DataFrame, shard_limit: int) -> DataFrame:
    """(key, fp): every two fingerprints at most three bits apart share a key."""
    rows = distinct.select(F.lit(0).cast("long").alias("key"), "fp", F.col("fp").alias("rest"))
    for level in range(ALWAYS):
        rows = split_once(rows, level)
    done = None
    for level in range(ALWAYS, len(LEVELS)):
        large = settle(rows.groupBy("key").count().filter(F.col("count") > shard_limit).select("key"), "large-shards")
        if large.isEmpty():
            break
        small = rows.join(large, "key", "left_anti").select("key", "fp")
        done = small if done is None else done.unionByName(small)
        rows = split_once(rows.join(large, "key", "left_semi"), level)
    last = rows.select("key", "fp")
    return last if done is None else done.unionByName(last)


def tree_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs of positions within ``radius`` bits, by a BK-tree that is grown and searched by all values at once.

    A node's children are keyed by their distance to it; a search with distance d follows only the
    edges from d - radius to d + radius.
    """
    links, todo = [], [(np.arange(len(values)), np.arange(len(values)))]
    while todo:
        nodes, searching = todo.pop()
        root = nodes[0]
        near = np.bitwise_count(values[searching] ^ values[root])
        links += [(int(root), int(q)) for q in searching[near <= radius] if q != root]
        if len(nodes) > 1:
            edge = np.bitwise_count(values[nodes[1:]] ^ values[root]).astype(np.int16)
            for d in np.unique(edge):
                follow = searching[np.abs(near.astype(np.int16) - d) <= radius]
                if len(follow):
                    todo.append((nodes[1:][edge == d], follow))
    return links


def spanning(n: int, links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """As many of the links' ends as hold the same components together: (member, root)."""
    root = list(range(n))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return [(x, top(x)) for x in range(n) if top(x) != x]


def links(distinct: DataFrame, radius: int, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all within ``radius`` bits (at most 3)."""
    if not 0 <= radius <= 3:
        raise ValueError("four blocks prove nothing beyond three bits")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = (np.empty(0, np.int64), np.empty(0, np.uint64))

        def found(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            size = np.diff(np.r_[begin, len(keys)])
            two = begin[size == 2]
            two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius]
            a, b = [fps[two]], [fps[two + 1]]
            for at, n in zip(begin[size > 2], size[size > 2], strict=True):
                own = fps[at : at + n]
                ends = np.array(spanning(n, tree_links(own, radius)), dtype=np.int64).reshape(-1, 2)
                a.append(own[ends[:, 0]])
                b.append(own[ends[:, 1]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate([left[0], batch.column("key").to_numpy()])
            fps = np.concatenate([left[1], batch.column("fp").to_numpy().view(np.uint64)])
            whole = np.searchsorted(keys, keys[-1]) if len(keys) else 0
            if whole:
                yield found(keys[:whole], fps[:whole])
            left = (keys[whole:], fps[whole:])
        if len(left[0]):
            yield found(*left)

    dealt = shards(distinct, shard_limit).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(search, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3, shard_limit: int = SHARD_LIMIT
) -> DataFrame:
    """id, fingerprint (16 hexadecimal digits) and component_id, the smallest id that links lead to."""
    rows = settle(fingerprints(docs, id_col, text_col, width), "fingerprints")
    first = settle(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    roots = components(links(first.select("fp"), radius, shard_limit), "a", "b")
    named = first.join(roots, first["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = named.join(least, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, text_col: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """The first row of each group of near duplicates, whatever its columns hold; repeated rows count as a group.

    Rows are numbered and written once, so that their numbers are the same when the kept ones are read again.
    """
    number = "row"
    while number in docs.columns:
        number += "_"
    rows = settle(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(rows, number, text_col, width, radius)
    kept = found.filter(F.col(number) == F.col("component_id")).select(number)
    return rows.join(kept, number, "left_semi").drop(number)

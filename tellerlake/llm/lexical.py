"""Ranked lexical search by scanning the documents with an Aho-Corasick automaton of the items' terms.

There is no index of documents. The terms of all items, each between two boundary marks, make one
automaton that is broadcast; an output of the automaton is a term, and a term knows the items that
hold it. A first scan counts documents, lengths and document frequencies; from them come the
weights. A second scan counts the terms of each document again, straight from its text, adds up
the scores of all items at once and keeps the best of each task; those are merged in two steps.

What is broadcast is measured first: items are dealt by a hash into blocks of at most ``block_bytes``
of terms (an item of more makes a block of its own size, the size of one text), and documents are
scanned for each block. Results of a task are bounded by k rows an item. Nothing depends on how often
a document, a term or a source occurs: there is no shuffle but that of frequencies (a row a term
and task) and of the best rows.

Terms are found in the UTF-8 bytes: every byte that is no ASCII digit, no ASCII letter and below 128
becomes the boundary mark, A-Z become a-z, all others stay.

Defined results: a null text has no terms and is not counted; a document without an id takes part
and ranks behind those with one at equal scores; repeated rows are documents of their own; rows of
one item_id are one item with the terms of all of them; items without terms, and empty tables, give no rows. Whole
texts of any length are scanned. Other columns are not read.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerlake.llm.common import in_small, picked
from tellerlake.session import settle

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = " "
BYTES = bytes(b if b > 127 or chr(b).isdigit() or chr(b) in LOWER else ord(chr(b).lower()) if chr(b) in UPPER else ord(MARK) for b in range(256))
BLOCK_BYTES = 8 * 1024 * 1024
PAIR_BYTES = 16
CELLS = 2_000_000
ROWS = 256


def guarded(text: bytes) -> bytes:
    """The text with terms between boundary marks."""
    return b" " + text.translate(BYTES) + b" "


def n_terms(marked: bytes) -> int:
    inside = np.frombuffer(marked, np.uint8) != ord(MARK)
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term), each once."""
    lowered = F.translate("text", UPPER, LOWER)
    found = picked(items, item=item_col, text=text_col).select("item", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
    return found.distinct()


class Block:
    """The terms of some items: their automaton, and which items hold a term."""

    def __init__(self, pairs: list[tuple[object, str]]):
        import ahocorasick

        self.items = list(dict.fromkeys(item for item, _ in pairs))
        numbers = {item: i for i, item in enumerate(self.items)}
        holders: dict[str, list[int]] = {}
        for item, term in pairs:
            holders.setdefault(term, []).append(numbers[item])
        self.automaton = ahocorasick.Automaton()
        for number, term in enumerate(holders):
            self.automaton.add_word(guarded(term.encode()).decode("latin-1"), number)
        self.automaton.make_automaton()
        self.sizes = np.array([len(h) for h in holders.values()], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.holders = np.array([i for h in holders.values() for i in h], np.int64)

    def counts(self, marked: bytes) -> Counter:
        """How often each term occurs."""
        return Counter(map(itemgetter(1), self.automaton.iter(marked.decode("latin-1"))))


def frequencies(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(term, n): documents that hold the term; under -1 the documents with terms, under -2 all their terms."""
    block, held = pickle.loads(shared.value), Counter()
    for batch in in_small(batches, ROWS):
        for text in batch.column("text"):
            marked = guarded(text.as_py() or b"")
            if n := n_terms(marked):
                held[-1] += 1
                held[-2] += n
                held.update(block.counts(marked).keys())
    yield pa.RecordBatch.from_pydict({"term": pa.array(list(held), pa.int64()), "n": pa.array(list(held.values()), pa.int64())})


class Best:
    """The best k documents of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.n_items, self.k = n_items, k
        self.floor = np.ones(n_items, np.int64)
        self.kept = tuple(np.empty(0, kind) for kind in (np.int64, np.int64, bool, np.int64))
        self.new: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, ids: np.ndarray, missing: np.ndarray, scores: np.ndarray) -> None:
        """scores: a row per document, a column per item."""
        row, item = np.nonzero(scores >= self.floor)
        self.new.append((item, scores[row, item], missing[row], ids[row]))
        self.waiting += len(row)
        if self.waiting > max(200_000, 2 * self.k * self.n_items):
            self.cut()

    def cut(self) -> None:
        item, score, missing, ids = (np.concatenate(c) for c in zip(self.kept, *self.new, strict=True))
        order = np.lexsort((ids, missing, -score, item))
        starts = np.searchsorted(item[order], np.arange(self.n_items))
        place = np.arange(len(order)) - starts[item[order]]
        order, place = order[place < self.k], place[place < self.k]
        self.kept = (item[order], score[order], missing[order], ids[order])
        last = place == self.k - 1
        self.floor[self.kept[0][last]] = self.kept[1][last]
        self.new, self.waiting = [], 0


def scores_of(block: Block, found: list[Counter], m: list[int], weights: np.ndarray) -> np.ndarray:
    """The score of every document with every item, in whole numbers."""
    row = np.repeat(np.arange(len(found)), [len(c) for c in found])
    term = np.fromiter((t for c in found for t in c), np.int64, len(row))
    tf = np.fromiter((n for c in found for n in c.values()), np.int64, len(row))
    gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.array(m, np.int64)[row]))
    n = block.sizes[term]
    at = np.arange(n.sum()) + np.repeat(block.first[term] - (np.cumsum(n) - n), n)
    cell = np.repeat(row, n) * len(block.items) + block.holders[at]
    gain = np.repeat(gain, n)
    shape = (len(found), len(block.items))
    # Two sums in floating point, each of parts so small that it is exact.
    high, low = (np.bincount(cell, part, shape[0] * shape[1]).astype(np.int64) for part in (gain >> 24, gain & (1 << 24) - 1))
    return ((high << 24) + low).reshape(shape)


def best_of_task(batches: Iterator[pa.RecordBatch], shared, weights: np.ndarray, n_docs: int, all_terms: int, k: int, item_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """(item_id, doc_id, score): the best k of this task for each item."""
    block = pickle.loads(shared.value)
    best = Best(len(block.items), k)
    step = max(1, min(ROWS, CELLS // max(len(block.items), len(block.holders))))
    for batch in in_small(batches, step):
        found, m = [], []
        for text in batch.column("text"):
            marked = guarded(text.as_py() or b"")
            found.append(block.counts(marked))
            m.append(100 - 50 + 50 * n_terms(marked) * n_docs // all_terms)
        ids = batch.column("id")
        best.add(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), scores_of(block, found, m, weights))
    best.cut()
    item, score, missing, ids = best.kept
    yield pa.RecordBatch.from_pydict({
        "item_id": pa.array(block.items, item_type).take(pa.array(item)), "doc_id": pa.array(ids, pa.int64(), mask=missing), "score": pa.array(score, pa.int64()),
    })


def blocks_of(spark: SparkSession, terms: DataFrame, block_bytes: int) -> Iterator[Block]:
    """The items in blocks of bounded size."""
    size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + PAIR_BYTES), F.lit(0))).first()[0]
    n = -(-size // block_bytes)
    for at in range(n):
        pairs = terms.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == at).collect()
        if pairs:
            yield Block([(p.item, p.term) for p in pairs])


def rank(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id, score: the best k documents of each item with a score above 0."""
    spark = docs.sparkSession
    source = picked(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    terms = settle(item_terms(items, item_col, item_text_col), "item-terms")
    kind = terms.schema["item"].dataType
    shown = T.StructType([T.StructField("item_id", kind), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    item_type = {f.name: f.type for f in spark.createDataFrame([], shown).toArrow().schema}["item_id"]
    found = spark.createDataFrame([], shown)
    for block in blocks_of(spark, terms, block_bytes):
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(block))
        counted = source.select("text").mapInArrow(lambda b, s=shared: frequencies(b, s), "term long, n long")
        held = {r.term: int(r.n) for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        if -1 not in held:
            continue
        n_docs, all_terms = held[-1], held[-2]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(block.sizes))], np.int64)
        found = found.unionByName(source.mapInArrow(
            lambda b, s=shared, w=weights, n=n_docs, a=all_terms: best_of_task(b, s, w, n, a, k, item_type), shown,
        ))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    near = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    near = near.withColumn("place", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))).filter(F.col("place") <= k)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")

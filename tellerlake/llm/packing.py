"""Best-fit packing of tokenised documents into sequences of a fixed length.

Best-fit decreasing looks only at lengths, so the plan is made from the histogram of piece lengths
(at most ``length`` rows): longest first, every item into the tightest open sequence, found in a
segment tree over the remaining capacities. Equal items are placed in runs: a run of equal
sequences takes a run of equal items, exactly as if they came one by one. The plan says, for each
length and rank among pieces of that length, the sequence and the place in it; ranks come from
counts per scan partition and length, so no task ever sees all pieces of a length.

Defined results: a null text is an empty one; an empty text is the end id alone; a null id is
kept; repeated rows are packed as often as they come; an empty table gives no rows. Columns other
than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerlake.llm.common import in_small, picked
from tellerlake.llm.tokens import encoder
from tellerlake.session import settle


class CapacityTree:
    """Segment tree over remaining capacities 0..top; a leaf is set while sequences with that much room are open."""

    def __init__(self, top: int):
        self.size = 1 << (top + 1).bit_length()
        self.open = bytearray(2 * self.size)

    def put(self, room: int, is_open: bool) -> None:
        node = room + self.size
        self.open[node] = is_open
        while node > 1:
            node >>= 1
            self.open[node] = self.open[2 * node] | self.open[2 * node + 1]

    def tightest(self, need: int) -> int | None:
        """The least open room that holds ``need``."""
        node = need + self.size
        if self.open[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def best_fit_plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, items per sequence, offset of the first item), by length and rank."""
    tree, rooms, made, rows = CapacityTree(capacity), {}, 0, []

    def give(room: int, first: int, count: int) -> None:
        if count and room:
            runs = rooms.setdefault(room, [])
            runs.append((first, count))
            if len(runs) == 1:
                tree.put(room, True)

    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        while left:
            room = tree.tightest(size)
            if room is None:
                room, first, count = capacity, made, -(-left // (capacity // size))
                made += count
            else:
                first, count = rooms[room].pop()
                if not rooms[room]:
                    tree.put(room, False)
            each = min(room // size, left)
            used = min(count, left // each)
            rows.append((size, rank, first, each, capacity - room))
            give(room - each * size, first, used)
            give(room, first + used, count - used)
            rank += used * each
            left -= used * each
    rows.sort()
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, length: int, keep_ids: bool) -> DataFrame:
    """One row per piece, with its scan partition and its index among that partition's pieces of the same length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(length + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in in_small(batches, 1000):
            row, piece, start, size, crc, index, ids = [], [], [], [], [], [], []
            for at, text in enumerate(batch.column("text")):
                data = encode(text.as_py() or "") + end
                for k, begin in enumerate(range(0, len(data), 4 * length)):
                    own = data[begin : begin + 4 * length]
                    n = len(own) // 4
                    row.append(at)
                    piece.append(k)
                    start.append(begin // 4)
                    size.append(n)
                    crc.append(zlib.crc32(own))
                    index.append(seen[n])
                    seen[n] += 1
                    if keep_ids:
                        ids.append(own)
            columns = [
                batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(size, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(row), pa.int32()), pa.array(index, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.binary())] if keep_ids else []), names=names)

    source = picked(docs, id=id_col, text=text_col)
    schema = T.StructType([
        T.StructField("id", source.schema["id"].dataType), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType()),
    ])
    if keep_ids:
        schema = schema.add("ids", T.BinaryType())
    names = schema.names
    return source.mapInArrow(cut, schema)


def pack(
    docs: DataFrame, tokenizer: str, length: int = 2048, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """Every piece with its sequence and its offset there; ``keep_ids`` adds the token ids (little-endian, 32 bits).

    ``tokenizer`` is the path of a tokenizer file that every executor can read.
    """
    cut = settle(pieces(docs, id_col, text_col, tokenizer, end_id, length, keep_ids), "pieces")
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = settle(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-ranks")
    histogram = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `length` rows
    plan = cut.sparkSession.sparkContext.broadcast(best_fit_plan(histogram, length))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rank, first, each, begin = plan.value.T
        by = (size << 44) | rank
        for batch in batches:
            own = {c: batch.column(c).to_numpy() for c in ("length", "rank")}
            row = np.searchsorted(by, (own["length"] << 44) | own["rank"], side="right") - 1
            nth = own["rank"] - rank[row]
            kept = [batch.column(c) for c in names[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(first[row] + nth // each[row]), pa.array(begin[row] + nth % each[row] * own["length"])], names=names
            )

    ranked = cut.join(bases.select("part", "length", "base"), ["part", "length"]).withColumn("rank", F.col("base") + F.col("at"))
    shown = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    schema = T.StructType([cut.schema[c] for c in shown]).add("sequence_id", T.LongType()).add("offset", T.LongType())
    names = schema.names
    return ranked.select(*shown, "rank").mapInArrow(place, schema).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The packed token sequences themselves, from ``pack(..., keep_ids=True)``: ids in order, and which document lies where."""
    members = F.array_sort(F.collect_list(F.struct("offset", "length", F.col(id_col).alias("id"), "piece", "ids")))
    return packed.groupBy("sequence_id").agg(members.alias("m")).select(
        "sequence_id",
        F.aggregate("m", F.lit(b""), lambda whole, m: F.concat(whole, m["ids"])).alias("ids"),
        F.transform("m", lambda m: F.struct(m["id"].alias(id_col), m["piece"].alias("piece"), m["offset"].alias("offset"), m["length"].alias("length"))).alias("places"),
    )

"""Repeated byte strings: every string of ``length`` bytes that starts at two or more places of a corpus.

Cutting the work: the gram with the least hash inside a string is its key, so equal strings have equal keys,
and neighbouring strings mostly share theirs. A run is a stretch of such neighbours: key, a hash of its
bytes, and its place. Keys seen once are done; runs equal to another run are repeated as a whole. Only
keys with different runs (the ends of repeated passages, and chance) need their bytes compared.

Comparing: the runs of many keys are laid in a row and their suffixes sorted, which gives the
Burrows-Wheeler transform and its backward step. Boundaries between suffixes are found breadth-first by
the length of the common prefix: a boundary between two suffixes, extended backwards by a symbol, is a
boundary of a prefix one symbol longer. The expansion stops at ``length``; rows without a boundary by then
share that many bytes with the row above. It stays within one text, as a separator follows each run.

Hot keys (more than ``hot_runs`` different runs, such as a line that is shorter than ``length``) are cut again
with longer grams, which reach into what stands around; the longest gram is the string itself, whose key leaves
nothing to compare. Copies of a run are counted before they are shuffled, so no task sees all copies.

Defined results: texts are UTF-8 bytes, a null text is an empty one; rows with the same id and text count as
different places; null ids are kept; an empty table gives no rows; texts shorter than ``length`` lose
nothing. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerlake.llm.common import in_small, picked
from tellerlake.session import settle

LENGTH = 200
BLOCK = 1 << 20
LONGEST_RUN = 512
HOT_RUNS = 4000
BATCH = 1 << 15
STEP = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)
# A run's place: first byte, then the number of strings less one.
PLACE_BITS = 10


def gram_sizes(length: int) -> list[int]:
    """About a third, two thirds and all but all of the length, then all of it."""
    least = 1 << max(0, (length // 3).bit_length() - 1)
    return sorted({least, min(2 * least, length), min(3 * least, length), length})


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * MIX
    return x ^ (x >> np.uint64(29))


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` bytes: halves make wholes, and the powers of two in ``size`` follow each other."""
    part, n, step = raw.astype(np.uint64) + np.uint64(1), 1, STEP
    found, have = None, 0
    count = len(raw) - size + 1
    while True:
        if size & n:
            own = part[have : have + count]
            found = own if found is None else mixed(found) * np.uint64(STEP) + own
            have += n
        if have == size:
            return mixed(found)
        part = part[:-n] * np.uint64(step) + part[n:]
        step = (step * step | 1) & (1 << 64) - 1
        n *= 2


def sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """Minimum or maximum of each ``width`` neighbours."""
    n = 1
    while 2 * n <= width:
        values = pick(values[:-n], values[n:])
        n *= 2
    return pick(values[: len(values) - (width - n)], values[width - n :]) if width > n else values


def runs(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a whole text: key, hash of the bytes, first byte, number of strings, and whether strings inside may be equal."""
    from xxhash import xxh3_64_intdigest

    parts, width = [], length - gram + 1
    for origin in range(0, max(len(data) - length + 1, 0), BLOCK):
        raw = np.frombuffer(data, np.uint8, min(BLOCK + length - 1, len(data) - origin), origin)
        grams = gram_hashes(raw, gram)
        least = sliding(grams, width, np.minimum)
        begin = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        size = np.diff(np.r_[begin, len(least)])
        if size.max() > LONGEST_RUN:
            pieces = -(-size // LONGEST_RUN)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = np.repeat(begin, pieces) + nth * LONGEST_RUN
            size = np.diff(np.r_[begin, len(least)])
        key = least[begin]
        # A gram that is the least of some string stands where it equals the greatest minimum around it.
        edge = np.zeros(width - 1, np.uint64)
        anchors = np.sort(grams[grams == sliding(np.r_[edge, least, edge], width, np.maximum)])
        again = np.isin(key, anchors[1:][anchors[1:] == anchors[:-1]])
        start = begin + origin
        whole = [xxh3_64_intdigest(data[s : s + n + length - 1]) for s, n in zip(start.tolist(), size.tolist(), strict=True)]
        parts.append((key.view(np.int64), np.array(whole, np.uint64).view(np.int64), start, size, again))
    if not parts:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty.astype(bool)
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def all_runs(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, hash, row, place, again) of all runs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small(batches, 1000):
            found = [runs(t.as_py(), length, gram) for t in batch.column("data")]
            key, whole, start, size, again = (np.concatenate(c) for c in zip(*found, strict=True))
            rows = np.repeat(batch.column("row").to_numpy(), [len(f[0]) for f in found])
            columns = [pa.array(c) for c in (key, whole, rows, (start << PLACE_BITS) | (size - 1), again)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "hash", "row", "place", "again"])

    return texts.select("row", "data").mapInArrow(work, "key long, hash long, row long, place long, again boolean")


def sorted_suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of at least ``depth`` symbols from there on (prefix doubling)."""
    n, have = len(symbols), 7
    both = np.zeros(n, np.int64)
    for k in range(have):  # seven symbols of nine bits fit a number
        both <<= 9
        both[: n - k] |= symbols[k:]
    while True:
        order = np.argsort(both)
        ordered = both[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        if have >= depth or rank[order[-1]] == n - 1:
            return order
        both = rank * (n + 1)
        both[: max(n - have, 0)] += rank[have:] + 1
        have *= 2


def shared_with_above(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix, in sorted order, shares ``length`` symbols with the one above it.

    Breadth-first over the length of common prefixes: ``following[r]`` is the row of the suffix one symbol
    shorter, the inverse of the transform's backward step. Rows r - 1 and r that begin with the same symbol part after
    l + 1 symbols exactly if the rows of their shorter suffixes have a boundary of length l between them
    (and none shorter, else r would be settled).
    """
    n = len(symbols)
    row = np.empty(n + 1, np.int64)
    row[order] = np.arange(n)
    row[n] = 0
    following = row[order + 1]
    first = symbols[order]
    boundary = np.r_[True, first[1:] != first[:-1]].astype(np.int32)
    open_ = np.flatnonzero(boundary == 0)
    low, high = following[open_ - 1], following[open_]
    for _ in range(1, length):
        if not len(open_):
            break
        passed = np.cumsum(boundary, dtype=np.int32)
        parted = np.flatnonzero(passed.take(high) != passed.take(low))
        new = open_.take(parted)
        if boundary.take(new).all():
            break  # no new boundary, so none will follow from it
        boundary[new] = 1
        if 8 * len(new) > len(open_):  # settled rows are dropped now and then
            rest = np.ones(len(open_), bool)
            rest[parted] = False
            open_, low, high = open_[rest], low[rest], high[rest]
    return boundary == 0


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text the positions at which a string starts that also starts elsewhere in these texts."""
    size = np.array([len(t) + 1 for t in texts])
    symbols = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int32) + 1
    begin = np.cumsum(size) - size
    symbols[begin + size - 1] = 0
    order = sorted_suffixes(symbols, length)
    above = shared_with_above(symbols, order, length)
    repeated = np.zeros(len(symbols), bool)
    repeated[order[above]] = True
    repeated[order[np.flatnonzero(above) - 1]] = True
    return [np.flatnonzero(repeated[b : b + max(n - length, 0)]) for b, n in zip(begin, size, strict=True)]


def as_runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of neighbouring positions: first, number."""
    if not len(starts):
        return starts, starts
    begin = np.flatnonzero(np.r_[True, np.diff(starts) > 1])
    return starts[begin], np.diff(np.r_[begin, len(starts)])


def compared(contents: DataFrame, length: int) -> DataFrame:
    """(row, start, size): repeated strings of the runs that have no equal, from (key, row, start, single, data)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bool, bytes]] = []
        total = 0

        def found() -> pa.RecordBatch:
            row, start, size = [], [], []
            for (_, r, s, single, _), repeated in zip(held, repeated_starts([h[4] for h in held], length), strict=True):
                if single:
                    first, number = as_runs(repeated)
                    row.append(np.full(len(first), r))
                    start.append(first + s)
                    size.append(number)
            columns = [pa.array(np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64)) for c in (row, start, size)]
            return pa.RecordBatch.from_arrays(columns, names=["row", "start", "size"])

        for batch in in_small(batches, 1000):
            columns = [batch.column(c).to_pylist() for c in ("key", "row", "start", "single", "data")]
            for entry in zip(*columns, strict=True):
                if total > BATCH and entry[0] != held[-1][0]:
                    yield found()
                    held, total = [], 0
                held.append(entry)
                total += len(entry[4])
        if held:
            yield found()

    ordered = contents.repartition("key").sortWithinPartitions("key")
    return ordered.select("key", "row", "start", "single", "data").mapInArrow(work, "row long, start long, size long")


def slices(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of ``wanted`` runs: (key, row, start, single, hot, data) from (key, single, hot, row, place)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small(batches, 100):
            out: list[list] = [[], [], [], [], [], []]
            for row, data, runs_ in zip(batch.column("row").to_pylist(), batch.column("data"), batch.column("runs").to_pylist(), strict=True):
                whole = data.as_py()
                for run in runs_:
                    start, size = run["place"] >> PLACE_BITS, (run["place"] & ((1 << PLACE_BITS) - 1)) + 1
                    own = (run["key"], row, start, run["single"], run["hot"], whole[start : start + size + length - 1])
                    for column, value in zip(out, own, strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["key", "row", "start", "single", "hot", "data"])

    by_row = wanted.groupBy("row").agg(F.collect_list(F.struct("key", "single", "hot", "place")).alias("runs"))
    shape = "key long, row long, start long, single boolean, hot boolean, data binary"
    return texts.join(by_row, "row").select("row", "data", "runs").mapInArrow(work, shape)


def cut_again(contents: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs by longer grams inside of runs (row, start, data), with their bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small(batches, 1000):
            out: list[list] = [[], [], [], [], [], []]
            for row, begin, data in zip(batch.column("row").to_pylist(), batch.column("start").to_pylist(), batch.column("data").to_pylist(), strict=True):
                for key, whole, start, size, again in zip(*(c.tolist() for c in runs(data, length, gram)), strict=True):
                    own = (key, whole, row, ((begin + start) << PLACE_BITS) | (size - 1), again, data[start : start + size + length - 1])
                    for column, value in zip(out, own, strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["key", "hash", "row", "place", "again", "data"])

    return contents.select("row", "start", "data").mapInArrow(work, "key long, hash long, row long, place long, again boolean, data binary")


def place_columns() -> list:
    return [F.shiftright("place", PLACE_BITS).alias("start"), (F.col("place").bitwiseAND((1 << PLACE_BITS) - 1) + 1).alias("size")]


def sorted_out(pieces: DataFrame, carried: list[str], hot_runs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of runs (key, hash, row, place, again and ``carried``): the repeated ones (row, start, size), and those to be
    compared with others of their key, each kind once: of ordinary keys and of hot ones."""
    seen = pieces.groupBy("key").agg(F.count("*").alias("n"), F.min("hash").alias("low"), F.max("hash").alias("high"), F.max("again").alias("again"))
    keys = settle(seen.filter("n > 1 or again").select("key", ((F.col("low") != F.col("high")) | F.col("again")).alias("open")), "repeated-keys")
    places = settle(pieces.join(keys, "key"), "repeated-runs")

    # Runs that differ from others of their key, once each; those that have copies are repeated anyway.
    distinct = places.filter("open").groupBy("key", "hash").agg(F.count("*").alias("n"), F.min(F.struct("row", "place", *carried)).alias("one"))
    once = settle(distinct.select("key", "hash", (F.col("n") == 1).alias("single"), "one.*"), "different-runs")
    load = settle(once.groupBy("key").agg(F.count("*").alias("n"), F.max("single").alias("single")).filter("single"), "open-keys")
    hot, mild = (settle(once.join(load.filter(c).select("key"), "key", "left_semi"), name) for c, name in ((F.col("n") > hot_runs, "hot-runs"), (F.col("n") <= hot_runs, "open-runs")))

    whole = places.filter("not open").select("row", *place_columns())
    copied = once.filter("not single").select("key", "hash")
    copies = places.filter("open").join(copied, ["key", "hash"], "left_semi").select("row", *place_columns())
    return whole.unionByName(copies), mild, hot


def repeated_strings(scan: DataFrame, length: int, hot_runs: int) -> DataFrame:
    """(row, start, size): stretches of starts of repeated strings; together they are all, some more than once.

    The bytes of all runs that need them are looked up at once, so that texts move as often whether there are hot keys or not.
    """
    first, *longer = gram_sizes(length)
    found, mild, hot = sorted_out(all_runs(scan, length, first), [], hot_runs)
    wanted = mild.withColumn("hot", F.lit(False)).unionByName(hot.withColumn("hot", F.lit(True)))
    looked_up = settle(slices(scan, wanted, length), "open-contents")
    found = found.unionByName(compared(looked_up.filter("not hot"), length))
    contents = looked_up.filter("hot")
    for gram in longer:
        if hot.isEmpty():
            break
        pieces = settle(cut_again(contents, length, gram), "hot-runs-cut")
        if gram == length:  # an equal key is an equal string, in a run as well as in two
            places = pieces.select("key", "row", *place_columns())
            again = places.groupBy("key").agg(F.count("*").alias("n"), F.max("size").alias("most")).filter("n > 1 or most > 1").select("key")
            found = found.unionByName(places.join(settle(again, "repeated-keys"), "key", "left_semi").drop("key"))
            break
        more, mild, hot = sorted_out(pieces, ["data"], hot_runs)
        contents = hot.select("row", *place_columns(), "data")
        found = found.unionByName(more).unionByName(compared(mild.select("key", "row", *place_columns(), "single", "data"), length))
    return found


def removed_spans(start: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of bytes covered by the strings that start there: begins, ends."""
    if not len(start):
        return start, start
    order = np.argsort(start, kind="stable")
    begin, end = start[order], (start + size + length - 1)[order]
    end = np.maximum.accumulate(end)
    first = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]])
    return begin[first], end[np.r_[first[1:] - 1, len(end) - 1]]


def without_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", hot_runs: int = HOT_RUNS, keep_text: bool = False
) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256; ``keep_text`` adds spans (begin, end in bytes) and the remaining bytes."""
    source = picked(docs, id=id_col, text=text_col).select("id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"))
    # Ids need not be unique: a row is known by its id and its text; equal rows are copies of each other.
    numbered = source.withColumn("row", F.xxhash64("id", "data"))
    scan = numbered.filter(F.octet_length("data") >= length).select("row", "id", "data")
    found = repeated_strings(scan, length, hot_runs)
    by_row = found.groupBy("row").agg(F.collect_list(F.struct("start", "size")).alias("strings"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small(batches, 200):
            removed, number, digest, spans, rest = [], [], [], [], []
            strings = batch.column("strings")
            for at, data in enumerate(batch.column("data")):
                own = strings[at].values
                begin, end = (np.empty(0, np.int64),) * 2 if own is None else removed_spans(own.field("start").to_numpy(), own.field("size").to_numpy(), length)
                whole = data.as_py()
                kept = whole
                if len(begin):
                    kept = b"".join(whole[a:b] for a, b in zip(np.r_[0, end].tolist(), np.r_[begin, len(whole)].tolist(), strict=True))
                removed.append(len(whole) - len(kept))
                number.append(len(begin))
                digest.append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    spans.append([{"begin": a, "end": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
                    rest.append(kept)
            columns = [batch.column("id"), pc.cast(pc.binary_length(batch.column("data")), pa.int64()), pa.array(removed, pa.int64()), pa.array(number, pa.int64()), pa.array(digest, pa.string())]
            if keep_text:
                columns += [pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), pa.array(rest, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType([source.schema["id"]]).add("n_bytes", T.LongType()).add("n_removed", T.LongType()).add("n_spans", T.LongType()).add("kept_sha256", T.StringType())
    if keep_text:
        schema = schema.add("spans", T.ArrayType(T.StructType().add("begin", T.LongType()).add("end", T.LongType()))).add("kept", T.BinaryType())
    names = schema.names
    long = scan.join(by_row, "row", "left").select("id", "data", "strings")
    short = source.filter(F.octet_length("data") < length).select("id", "data", F.lit(None).cast("array<struct<start:long,size:long>>").alias("strings"))
    return long.unionByName(short).mapInArrow(work, schema).withColumnRenamed("id", id_col)

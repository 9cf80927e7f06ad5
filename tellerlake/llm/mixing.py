"""Mixing overlapping sources to target token weights by min-cost flow.

A document may belong to several sources. Documents are aggregated by membership pattern (their
set of sources); a pattern's words can be used up to ``max_repeats`` times, each further time at a
higher price (1, 4, 9, ...: convex, so that flow fills first uses everywhere before second ones). Flow runs from
patterns to the sources they belong to and on to the sources' targets. The flow of a pattern over
its size says how often its documents are taken: all of them ``k`` times, and one more time those
that come first in a seeded hash order, up to the rest; documents that do not fit are passed over.

The driver holds one row per pattern and source: the number of patterns is assumed to be small, as
sources are (it does not grow with the documents). Where the hash order is cut is found digit by digit in counts of 256 rows per pattern,
so nothing is sorted and no task sees all documents of a source.

Defined results: a null text has size 0; a null source is a source of its own, ordered last;
documents without words are taken 0 times; repeated rows are documents of their own with equal
choice (same id, text and source: all are taken once more or none); an empty table gives no rows. Other columns pass through
unread, unless the operator's own names (size, source_size, target, taken) clash, which replace them.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerlake.llm.common import column
from tellerlake.session import settle

WORD = r"[^\x20\x09-\x0D]+"
DIGIT_BITS, DIGITS = 8, 7


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: Sequence[int], weights: Sequence[float], limit: float) -> list[float]:
    """Shares of the whole by weight, none above ``limit`` times its size; the excess goes to the others by weight."""
    total, fixed = float(sum(sizes)), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest, weight = total - sum(fixed.values()), sum(weights[i] for i in free)
        shares = {i: rest * weights[i] / weight for i in free}
        over = [i for i in free if shares[i] > limit * sizes[i]]
        if not over:
            return [fixed.get(i, shares.get(i, 0.0)) for i in range(len(sizes))]
        fixed |= {i: float(limit * sizes[i]) for i in over}


def min_cost_flow(patterns: dict[tuple[int, ...], int], targets: Sequence[int], max_repeats: int) -> dict[tuple[tuple[int, ...], int], int]:
    """Words that each pattern gives to each of its sources: as much of the targets as can be met, at the least price.

    Successive shortest paths with potentials; nodes are the patterns and sources, so the graph is small.
    """
    names = list(patterns)
    start, end = len(names) + len(targets), len(names) + len(targets) + 1
    arcs: list[list[int]] = []  # head, room, price; the arc back is the next one
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def arc(a: int, b: int, room: int, price: int) -> None:
        for tail, entry in ((a, [b, room, price]), (b, [a, 0, -price])):
            out[tail].append(len(arcs))
            arcs.append(entry)

    for i, pattern in enumerate(names):
        for k in range(1, max_repeats + 1):
            arc(start, i, patterns[pattern], k * k)
        for s in pattern:
            arc(i, len(names) + s, max_repeats * patterns[pattern], 0)
    for s, target in enumerate(targets):
        arc(len(names) + s, end, target, 0)

    potential = [0] * (end + 1)
    while True:
        far, via, queue = {start: 0}, {}, [(0, start)]
        while queue:
            d, node = heapq.heappop(queue)
            if d > far[node]:
                continue
            for e in out[node]:
                head, room, price = arcs[e]
                step = d + price + potential[node] - potential[head]
                if room > 0 and step < far.get(head, step + 1):
                    far[head], via[head] = step, e
                    heapq.heappush(queue, (step, head))
        if end not in far:
            break
        for node in range(end + 1):
            potential[node] += far.get(node, far[end])
        path, node = [], end
        while node != start:
            path.append(via[node])
            node = arcs[via[node] ^ 1][0]
        pushed = min(arcs[e][1] for e in path)
        for e in path:
            arcs[e][1] -= pushed
            arcs[e ^ 1][1] += pushed
    return {
        (names[i], arcs[e][0] - len(names)): arcs[e ^ 1][1]
        for i in range(len(names)) for e in out[i] if e % 2 == 0 and arcs[e][0] < start and arcs[e ^ 1][1] > 0
    }


def cut_points(sized: DataFrame, rest: dict[int, int], begin: dict[int, int]) -> tuple[dict[int, int], dict[int, int]]:
    """For each pattern the hash below which documents hold at most ``rest`` words, and the words still missing.

    Documents before ``begin`` or with more than ``rest`` words are passed over. One digit of the hash per round; a
    round counts only the documents that share the digits found so far.
    """
    spark = sized.sparkSession
    found, left = {p: 0 for p in rest}, dict(rest)
    counting = {p for p in rest if rest[p] > 0}
    for digit in range(DIGITS):
        if not counting:
            break
        shift = DIGIT_BITS * (DIGITS - 1 - digit)
        facts = [(p, found[p], begin[p], rest[p]) for p in sorted(counting)]
        known = spark.createDataFrame(facts, "pattern int, prefix long, begin long, most long")
        rows = (
            sized.join(F.broadcast(known), "pattern")  # a row per pattern
            .filter((F.shiftright("order", shift + DIGIT_BITS) == F.col("prefix")) & (F.col("order") >= F.col("begin")) & (F.col("size") <= F.col("most")))
            .groupBy("pattern", (F.shiftright("order", shift).bitwiseAND(2**DIGIT_BITS - 1)).alias("digit"))
            .agg(F.sum("size").alias("size"), F.count("*").alias("docs")).collect()
        )
        sums: dict[int, dict[int, tuple[int, int]]] = {}
        for r in rows:
            sums.setdefault(r["pattern"], {})[r["digit"]] = (r["size"], r["docs"])
        for p in sorted(counting):
            chosen = 2**DIGIT_BITS
            for d, (size, _) in sorted(sums.get(p, {}).items()):
                if size > left[p]:
                    chosen = d
                    break
                left[p] -= size
            found[p] = (found[p] << DIGIT_BITS) + chosen
            if chosen == 2**DIGIT_BITS or sums[p][chosen][1] == 1 or digit == DIGITS - 1:
                found[p] <<= shift
                counting.discard(p)
    return found, left


def cuts(sized: DataFrame, rest: dict[int, int]) -> dict[int, list[tuple[int, int, int]]]:
    """For each pattern ranges of hashes (from, below, largest size) whose documents hold ``rest`` words together, as far as any fit.

    The document at which a range ends does not fit, nor will it later: the search goes on behind it, with less missing.
    """
    found: dict[int, list[tuple[int, int, int]]] = {p: [] for p in rest}
    left, begin = {p: r for p, r in rest.items() if r > 0}, dict.fromkeys(rest, 0)
    while left:
        below, missing = cut_points(sized, left, begin)
        for p in below:
            found[p].append((begin[p], below[p], left[p]))
            begin[p] = below[p] + 1
        left = {p: m for p, m in missing.items() if m > 0 and below[p] < 2 ** (DIGIT_BITS * DIGITS)}
    return found


def mix(
    docs: DataFrame, sources: Column, weights: Sequence[float] = (1, 2, 3), max_repeats: int = 3, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """All columns, and size, source_size and target (of the first source of the document), and taken (a multiple of size).

    ``sources`` is the array of a document's sources; elements may be null, an empty or null array
    counts as the null source. Sources are ordered by code point, null last; ``weights`` repeat.
    """
    spark = docs.sparkSession
    own = ("size", "source_size", "target", "taken")
    names = F.when(F.coalesce(F.size(sources), F.lit(0)) < 1, F.array(F.lit(None).cast("string"))).otherwise(sources)
    spread = F.array_sort(F.array_distinct(F.transform(names, lambda s: F.struct(s.isNull().alias("last"), s.cast("string").alias("name")))))
    kept = docs.select(*[column(c).alias(f"kept_{i}") for i, c in enumerate(docs.columns) if c not in own], spread.alias("members"),
                       words(column(text_col)).alias("size"),
                       F.shiftrightunsigned(F.xxhash64(F.lit(seed), column(id_col), column(text_col), F.to_json(F.struct(spread))), 64 - DIGIT_BITS * DIGITS).alias("order"))
    base = kept.withColumn("key", F.to_json(F.struct("members")))
    narrow = settle(base.select("key", "size", "order"), "mix-sizes")

    patterns = narrow.groupBy("key").agg(F.sum("size").alias("size")).orderBy("key").collect()
    named = [[(m["last"], m.get("name", "")) for m in json.loads(r["key"])["members"]] for r in patterns]
    labels = sorted({label for pattern in named for label in pattern})
    number = {label: i for i, label in enumerate(labels)}
    member = [tuple(number[label] for label in pattern) for pattern in named]
    sizes = [sum(r["size"] for r, own_ in zip(patterns, member, strict=True) if i in own_) for i in range(len(labels))]
    # Overlaps count in each of their sources, so shares are taken of what there is in all.
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(labels))], max_repeats) if labels else []
    flow = min_cost_flow({m: r["size"] for m, r in zip(member, patterns, strict=True)}, rounded(targets), max_repeats)
    given = [sum(flow.get((m, s), 0) for s in m) for m in member]
    repeats = [g // r["size"] if r["size"] else 0 for g, r in zip(given, patterns, strict=True)]
    rest = {i: g - k * r["size"] for i, (g, k, r) in enumerate(zip(given, repeats, patterns, strict=True))}
    schema = T.StructType.fromDDL("key string, pattern int, repeats long, source_size long, target double")
    facts = [(r["key"], i, repeats[i], sizes[member[i][0]], targets[member[i][0]]) for i, r in enumerate(patterns)]
    table = F.broadcast(spark.createDataFrame(facts, schema))
    sized = narrow.join(table.select("key", "pattern"), "key").select("pattern", "size", "order")
    ranges = sorted(cuts(sized, rest).items())
    limits = F.broadcast(spark.createDataFrame(ranges, "pattern int, ranges array<struct<begin: long, below: long, most: long>>"))
    inside = lambda r: (F.col("order") >= r["begin"]) & (F.col("order") < r["below"]) & (F.col("size") <= r["most"])
    once_more = F.exists("ranges", inside)
    taken = (F.col("repeats") + once_more.cast("long")) * F.col("size")
    chosen = base.join(table, "key").join(limits, "pattern").withColumn("taken", taken)
    back = [F.col(f"kept_{i}").alias(c) for i, c in enumerate(docs.columns) if c not in own]
    return chosen.select(*back, *own)


def rounded(targets: Sequence[float]) -> list[int]:
    """Whole numbers with the same sum as far as it is whole: running totals are rounded, not the parts."""
    totals = [0.0]
    for t in targets:
        totals.append(totals[-1] + t)
    return [round(b) - round(a) for a, b in pairwise(totals)]

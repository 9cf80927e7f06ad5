"""Secret scan: named patterns, and windows of high Shannon entropy per character class, with an allow-list.

All in expressions of Spark, one pass over the texts, no shuffle and no Python on the executors.

Named patterns (kinds assign, access, hex) are matched leftmost and without overlap; what fails its check
of length is dropped. Beside them, maximal runs of a character class (hexadecimal digits; the characters
of Base64) of at least ``WINDOW`` characters are candidates. A window of that many characters slides over a candidate;
the counts of its characters are kept while one enters and one leaves, and with them the sum of
n log2 n, in whole millionths, which gives the entropy of the window. Windows that reach the class's bits are merged
where they overlap or touch. An allow-list then suppresses spans that are plainly none: without any
digit or without any letter, UUIDs, alphabets and other sequences, placeholders, and digests named
as such just before them. It never touches the named patterns.

Positions come from splitting the text at the matches and adding up lengths, by blocks, so that the work stays
in proportion to the text however many matches it holds.

Defined results: a null text counts as empty; repeated rows and rows without an id are scanned like
all others; texts of any length are scanned whole; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.common import picked

WINDOW = 24
UNIT = 1_000_000
BLOCK = 128
CONTEXT = 24


@dataclass(frozen=True)
class Named:
    """A pattern whose ``group`` must have at least ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int


@dataclass(frozen=True)
class CharacterClass:
    """Runs of these characters are searched for windows of at least so many bits a character."""

    kind: str
    pattern: str
    alphabet: str
    bits: float


DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
NAMED = (
    # (?i:...) folds ASCII letters only.
    Named("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Named("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    Named("hex", "[0-9a-f]{24,}", 0, 24),
)
CLASSES = (
    CharacterClass("entropy_hex", f"[0-9A-Fa-f]{{{WINDOW},}}", DIGITS + "abcdefABCDEF", 3.0),
    CharacterClass("entropy_base64", f"[A-Za-z0-9+/_-]{{{WINDOW},}}", DIGITS + LOWER + LOWER.upper() + "+/_-", 3.9),
)
ALLOWED = (
    "^[^0-9]+$",
    "^[^A-Za-z]+$",
    "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    "(?i)0123456789|abcdefgh|qwertyui",
    "(?i)example|sample|dummy|placeholder|changeme|redacted|xxxxxx",
)
ALLOWED_BEFORE = r"""(?i)(sha-?[0-9]{1,3}|md5|checksum|integrity|digest|commit|etag|uuid)["']?[-:= ]{1,3}["']?\z"""


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def tail(*texts: Column) -> Column:
    """The last characters that serve as context."""
    return F.substring(F.concat(*texts), -CONTEXT, CONTEXT)


def with_positions(steps: Column) -> Column:
    """(start, end, before, found, part) from the texts before each match and the matches themselves, of which there is at least one."""

    def length(x: Column) -> Column:
        return F.length(x["0"]) + F.length(x["1"])

    def ends(block: Column, offset: Column) -> Column:
        first = F.struct(offset.alias("at"), F.array().cast("array<struct<start:int,end:int,before:string,found:string,part:string>>").alias("out"))
        return F.aggregate(block, first, lambda acc, x: F.struct(
            (acc["at"] + length(x)).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + F.length(x["0"])).alias("start"), (acc["at"] + length(x)).alias("end"),
                x["before"].alias("before"), x["1"].alias("found"), x["2"].alias("part"),
            ))).alias("out"),
        ), lambda acc: acc["out"])

    def offsets(blocks: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(blocks, first, lambda acc, block: F.struct(
            F.aggregate(block, acc["at"], lambda n, x: n + length(x)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"),
        ), lambda acc: acc["out"])

    def blocks(s: Column) -> Column:
        last = F.floor((F.size(s) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(s, b * BLOCK + 1, BLOCK))

    def with_context(s: Column) -> Column:
        """Each step with the last characters before its match, which may reach into the match before."""
        return F.transform(s, lambda x, i: F.struct(
            x["0"].alias("0"), x["1"].alias("1"), x["2"].alias("2"), tail(F.when(i > 0, tail(s[i - 1]["1"])).otherwise(""), x["0"]).alias("before"),
        ))

    return let(let(steps, with_context), lambda s: let(blocks(s), lambda b: F.flatten(F.zip_with(b, offsets(b), ends))))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern, leftmost and without overlap: (start, end, before, found, part), counted in code points."""
    found = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group)]
    steps = F.filter(F.arrays_zip(F.split(text, pattern, -1), *found), lambda x: x["1"].isNotNull())
    none = F.array().cast("array<struct<start:int,end:int,before:string,found:string,part:string>>")
    return F.when(text.rlike(pattern), with_positions(steps)).otherwise(none)


def excess(n: int) -> int:
    """n log2 n in whole millionths."""
    return round(n * math.log2(n) * UNIT) if n else 0


def limit(bits: float, window: int) -> int:
    """The most that the sum of n log2 n may be in a window of that entropy."""
    return round(window * (math.log2(window) - bits) * UNIT)


def dense_windows(candidate: Column, alphabet: str, bits: float, window: int) -> Column:
    """(start, end) of the merged windows of a candidate that hold at least so many bits a character."""
    table = F.array(*[F.lit(excess(n)).cast("long") for n in range(window + 2)])
    codes = F.transform(F.split(candidate, ""), lambda c: F.call_function("instr", F.lit(alphabet), c))
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    first = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0).cast("long").alias("sum"),
        F.lit(0).alias("start"), F.lit(-1).alias("end"), nothing.alias("out"),
    )

    def closed(acc: Column) -> Column:
        return F.when(acc["start"] > 0, F.concat(acc["out"], F.array(F.struct((acc["start"] - 1).alias("start"), acc["end"].alias("end"))))).otherwise(acc["out"])

    def merged(acc: Column, done: Column) -> dict[str, Column]:
        """What the window that ends with character ``done`` changes."""
        dense = (done >= window) & (acc["sum"] <= limit(bits, window))
        fresh = dense & (done - window > acc["end"])
        return {
            "start": F.when(fresh, done - window + 1).otherwise(acc["start"]), "end": F.when(dense, done).otherwise(acc["end"]),
            "out": F.when(fresh, closed(acc)).otherwise(acc["out"]),
        }

    def grown(acc: Column, i: Column, letters: Column, tables: Column) -> Column:
        """Character i enters, character i - window leaves, after the window before has been judged."""
        enters, leaves = letters[i - 1], F.when(i > window, letters[i - window - 1]).otherwise(0)
        there, left = acc["counts"][enters - 1], acc["counts"][leaves - 1] + (leaves == enters).cast("int")
        won = tables[there + 1] - tables[there]
        lost = F.when(leaves > 0, tables[left] - tables[left - 1]).otherwise(0)
        counts = F.transform(acc["counts"], lambda n, j: n + (j + 1 == enters).cast("int") - (j + 1 == leaves).cast("int"))
        return F.struct(counts.alias("counts"), (acc["sum"] + won - lost).alias("sum"), *[v.alias(k) for k, v in merged(acc, i - 1).items()])

    def finished(acc: Column, n: Column) -> Column:
        return let(F.struct(*[v.alias(k) for k, v in merged(acc, n).items()]), closed)

    return let(table, lambda tables: let(codes, lambda letters: F.aggregate(
        F.sequence(F.lit(1), F.size(letters)), first, lambda acc, i: grown(acc, i, letters, tables), lambda acc: finished(acc, F.size(letters)),
    )))


def named_spans(text: Column, rule: Named) -> Column:
    """(start, end, found) of a named pattern."""
    kept = F.filter(matches(text, rule.pattern, rule.group), lambda x: F.length(x["part"]) >= rule.least)
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["found"].alias("found")))


def entropy_spans(text: Column, kind: CharacterClass, window: int) -> Column:
    """(start, end, found, before) of the dense windows of all candidates of a class."""

    def of_candidate(x: Column) -> Column:
        return F.transform(dense_windows(x["found"], kind.alphabet, kind.bits, window), lambda w: F.struct(
            (x["start"] + w["start"]).alias("start"), (x["start"] + w["end"]).alias("end"),
            F.substring(x["found"], w["start"] + 1, w["end"] - w["start"]).alias("found"),
            tail(x["before"], F.substring(x["found"], F.lit(1), w["start"])).alias("before"),
        ))

    return F.flatten(F.transform(matches(text, kind.pattern), of_candidate))


def suppressed(x: Column, allowed: Sequence[str], before: str) -> Column:
    found = F.lit(False)
    for pattern in allowed:
        found = found | x["found"].rlike(pattern)
    return found | x["before"].rlike(before) if before else found


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", named: Sequence[Named] = NAMED, classes: Sequence[CharacterClass] = CLASSES,
    window: int = WINDOW, allowed: Sequence[str] = ALLOWED, allowed_before: str = ALLOWED_BEFORE,
) -> DataFrame:
    """doc_id, a column of (start, end, found) for each kind, and n_allowed: how many dense spans the allow-list suppressed."""
    source = picked(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    text = F.col("text")
    out = source.select("doc_id", *[named_spans(text, n).alias(n.kind) for n in named], *[entropy_spans(text, c, window).alias(f"all_{c.kind}") for c in classes])
    shown, hidden = [], [F.lit(0).cast("long")]
    for c in classes:
        kept = F.filter(f"all_{c.kind}", lambda x: ~suppressed(x, allowed, allowed_before))
        shown.append(F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["found"].alias("found"))).alias(c.kind))
        hidden.append((F.size(f"all_{c.kind}") - F.size(kept)).cast("long"))
    return out.select("doc_id", *[n.kind for n in named], *shown, sum(hidden[1:], hidden[0]).alias("n_allowed"))


def listed(kinds: Sequence[str]) -> Column:
    """kind:start:end of the spans of these kinds, by start, then by kind in the order given."""

    def numbered(kind: str, n: int) -> Column:
        return F.transform(kind, lambda x: F.struct(x["start"].alias("start"), F.lit(n).alias("n"), x["end"].alias("end")))

    marked = [numbered(k, n) for n, k in enumerate(kinds)]
    name = F.array(*[F.lit(k) for k in kinds])
    shown = F.transform(F.array_sort(F.concat(*marked)), lambda x: F.concat_ws(":", F.element_at(name, x["n"] + 1), x["start"], x["end"]))
    return F.array_join(shown, ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the named kinds, base_sha256 over their spans, spans: all of them; n_entropy and n_allowed beside."""
    base, added = [n.kind for n in NAMED], [c.kind for c in CLASSES]
    found = scan(docs, id_col, text_col)
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in base], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed([*base, *added]).alias("spans"), sum((F.size(k).cast("long") for k in added[1:]), F.size(added[0]).cast("long")).alias("n_entropy"), "n_allowed",
    )

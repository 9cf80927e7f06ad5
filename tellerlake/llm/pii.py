"""Personal data in texts by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

Base spans (e-mail, IP address, card, phone) are found by strict patterns and always stay. Looser
patterns propose further candidates. On every candidate labelers vote yes, no or nothing: form,
checksum, gazetteer, words around it, neighbours and layout. Votes and surface features of a
candidate are one small number, its pattern; only counts of patterns (at most ``PATTERNS``) leave
the tasks. Expectation-maximisation over these counts estimates how reliable each labeler is per
kind, and a logistic classifier trained on the resulting probabilities decides on each pattern.
Every candidate of every document counts; nothing is sampled.

All searches take time in proportion to the text: patterns start only where a run of their
characters starts.

Defined results: a null or empty text has no spans; repeated rows each get their row; a null id is
kept; an empty table gives no rows. Columns other than the id and the text are only passed through
(by ``redact``).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerlake.llm.common import in_small, picked
from tellerlake.session import settle

KINDS = ("email", "ip", "card", "phone")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]|[\[(]at[\])]|[A-Fa-f]:[A-Fa-f]")
SPELLED_AT = re.compile(r"\x20?[\[(]at[\])]\x20?")
SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++")
IP6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
LOCAL_PHONE = re.compile(r"(?<![0-9+().-])\(?[0-9][\x20().0-9-]+[0-9](?![0-9])")

# Gazetteers and context words.
TOP_LEVEL = frozenset("com org net edu gov info biz io de fr es it uk eu us ca ch at nl be pt br mx co jp cn in au".split())
CALLING_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
ISSUER = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38|62")
NEAR = {
    "email": "mail e-mail email correo courriel kontakt contact write",
    "ip": "ip host server address adresse dirección addr login",
    "card": "card visa mastercard amex carte tarjeta karte kreditkarte payment paid",
    "phone": "phone tel call mobile fax telefon teléfono téléphone ruf sms whatsapp",
}
NEAR_WORDS = {kind: frozenset(words.split()) for kind, words in NEAR.items()}
AGAINST_WORDS = frozenset("version isbn issn order invoice ref page chapter section serial sku part release build build no nr".split())
WORD = re.compile(r"[\w-]+")
CONTEXT_CHARS, NEIGHBOUR_CHARS = 40, 80

LABELERS = ("form", "checksum", "gazetteer", "context", "neighbour", "layout")
NO, NOTHING, YES = 0, 1, 2
LENGTHS = (8, 10, 12, 14, 16, 20, 28)
SURFACE = (len(LENGTHS) + 1) * 3 * 3
PATTERNS = len(KINDS) * 3 ** len(LABELERS) * SURFACE


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        n = int(d) * (1 + at % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str, at: re.Pattern, domain: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost matches of local part, at sign, domain; searched from the at signs, so in linear time."""
    found, free = [], 0
    for sign in at.finditer(text):
        begin = sign.start()
        if begin < free:
            continue
        after = domain.match(text, sign.end())
        if after is None:
            free = max(free, sign.end()) if at is AT else free
            continue
        while begin > free and LOCAL.match(text[begin - 1]):
            begin -= 1
        if begin < sign.start():
            found.append((begin, after.end()))
            free = after.end()
    return found


AT = re.compile("@")


def only_digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, checks passed; by kind, then start; in code points."""
    spans = [(0, a, b) for a, b in emails(text, AT, DOMAIN)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            spans.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            spans.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(only_digits(m[0])) <= 15:
            spans.append((3, *m.span()))
    return spans


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates that overlap no base span and no earlier candidate."""
    taken: list[tuple[int, int]] = []  # apart from each other, in order
    for _, a, b in sorted(base, key=lambda s: s[1]):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    found = []

    def offer(kind: int, begin: int, end: int) -> None:
        at = bisect_left(taken, (begin, end))
        if (at == 0 or taken[at - 1][1] <= begin) and (at == len(taken) or end <= taken[at][0]):
            taken.insert(at, (begin, end))
            found.append((kind, begin, end))

    for a, b in emails(text, SPELLED_AT, SPELLED_DOMAIN):
        offer(0, a, b)
    for m in IP6.finditer(text):
        offer(1, *m.span())
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 38 and 13 <= len(only_digits(m[0])) <= 19:
            offer(2, *m.span())
    for m in LOCAL_PHONE.finditer(text):
        digits = only_digits(m[0])
        if 8 <= len(digits) <= 15 and len(digits) < m.end() - m.start() and "." not in m[0]:
            offer(3, *m.span())
    return sorted(found)


def votes(text: str, kind: int, begin: int, end: int, strict: bool, others: list[tuple[int, int, int]]) -> list[int]:
    """One vote per labeler."""
    own, name = text[begin:end], KINDS[kind]
    digits = only_digits(own)
    if kind == 0:
        top = own.rpartition(".")[2].strip(" )]").lower()
        valid, listed = ".." not in own and not own.startswith("."), top in TOP_LEVEL
        tidy = bool(re.fullmatch(r"[A-Za-z0-9][\w.+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", own))
    elif kind == 1:
        valid, listed = True, not digits.startswith("0")
        tidy = not (end < len(text) and text[end] == "." and end + 1 < len(text) and text[end + 1].isdigit())
    elif kind == 2:
        valid, listed = luhn(digits), bool(ISSUER.match(digits))
        tidy = bool(re.fullmatch(r"[0-9]{16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[0-9]{3}[ -]?[0-9]{6}[ -]?[0-9]{5}", own))
    else:
        valid = 10 <= len(digits) <= 15
        listed = own.startswith("+") and any(digits[:n] in CALLING_CODES for n in (1, 2))
        tidy = own.count("(") == own.count(")") and not re.search(r"[ .-]{2}", own)
    around = {w.lower() for w in WORD.findall(text[max(0, begin - CONTEXT_CHARS) : begin])}
    context = YES if around & NEAR_WORDS[name] else NO if around & AGAINST_WORDS else NOTHING
    near = any(a != begin and a < end + NEIGHBOUR_CHARS and b > begin - NEIGHBOUR_CHARS for _, a, b in others)
    return [YES if strict else NO, YES if valid else NO, YES if listed else NO, context, YES if near else NOTHING, YES if tidy else NO]


def side(char: str) -> int:
    return 0 if not char or char.isspace() else 1 if not char.isalnum() else 2


def pattern_of(text: str, kind: int, begin: int, end: int, strict: bool, others: list[tuple[int, int, int]]) -> int:
    """Kind, votes and surface features as one number below ``PATTERNS``."""
    code = kind
    for v in votes(text, kind, begin, end, strict, others):
        code = 3 * code + v
    length = sum(end - begin >= n for n in LENGTHS)
    return ((code * (len(LENGTHS) + 1) + length) * 3 + side(text[begin - 1 : begin])) * 3 + side(text[end : end + 1])


def candidates(text: str) -> list[tuple[int, int, int, bool, int]]:
    """(kind, start, end, strict, pattern) of a whole text, strict ones first."""
    if not HINT.search(text):
        return []
    base = base_spans(text)
    loose = loose_spans(text, base)
    every = sorted(base + loose, key=lambda s: s[1])
    starts = [s[1] for s in every]

    def beside(begin: int, end: int) -> list[tuple[int, int, int]]:
        low, high = bisect_left(starts, begin - NEIGHBOUR_CHARS), bisect_left(starts, end + NEIGHBOUR_CHARS)
        return every[max(0, low - 1) : high]

    return [(k, a, b, strict, pattern_of(text, k, a, b, strict, beside(a, b))) for own, strict in ((base, True), (loose, False)) for k, a, b in own]


def read_pattern(code: int) -> tuple[int, list[int], list[int]]:
    code, right = divmod(code, 3)
    code, left = divmod(code, 3)
    code, length = divmod(code, len(LENGTHS) + 1)
    cast = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        cast.append(v)
    return code, cast[::-1], [length, left, right]


def reliabilities(kind: np.ndarray, cast: np.ndarray, count: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Probability of each pattern to be personal data, by expectation-maximisation over vote counts.

    Per kind a prior, and per kind and labeler how often it votes what on true and on false candidates
    (with one pseudo-vote each); the first guess is the majority vote.
    """
    true = np.clip(0.5 + 0.4 * (cast - 1).mean(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        logit = np.zeros(len(kind))
        for k in np.unique(kind):
            at = kind == k
            yes, no = true[at] * count[at], (1 - true[at]) * count[at]
            own = np.full(at.sum(), np.log((yes.sum() + 1) / (no.sum() + 1)))
            for labeler in range(cast.shape[1]):
                v = cast[at, labeler]
                on_yes = np.bincount(v, yes, 3) + 1
                on_no = np.bincount(v, no, 3) + 1
                ratio = np.log(on_yes / on_yes.sum()) - np.log(on_no / on_no.sum())
                own += np.where(v == NOTHING, 0, ratio[v])
            logit[at] = own
        true = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return true


def design(codes: list[int]) -> np.ndarray:
    """One-hot features of patterns for the classifier: kind, kind and vote, surface."""
    rows = []
    for code in codes:
        kind, cast, surface = read_pattern(code)
        row = np.zeros(1 + len(KINDS) * (1 + 3 * len(LABELERS)) + len(LENGTHS) + 1 + 6)
        row[0] = 1
        own = 1 + kind * (1 + 3 * len(LABELERS))
        row[own] = 1
        for i, v in enumerate(cast):
            row[own + 1 + 3 * i + v] = 1
        tail = 1 + len(KINDS) * (1 + 3 * len(LABELERS))
        row[tail + surface[0]] = 1
        row[tail + len(LENGTHS) + 1 + surface[1]] = 1
        row[tail + len(LENGTHS) + 4 + surface[2]] = 1
        rows.append(row)
    return np.array(rows)


def logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Coefficients of a ridge-regularised logistic regression on soft targets, by Newton's method."""
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, x.T @ (weight * (target - p)) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def classifier(counts: dict[int, int]) -> set[int]:
    """The patterns that the trained classifier accepts."""
    if not counts:
        return set()
    codes = sorted(counts)
    read = [read_pattern(c) for c in codes]
    count = np.array([counts[c] for c in codes], dtype=float)
    true = reliabilities(np.array([r[0] for r in read]), np.array([r[1] for r in read]), count)
    x = design(codes)
    score = x @ logistic(x, true, count)
    return {c for c, s in zip(codes, score, strict=True) if s >= 0}


SPANS = "array<struct<kind:int,start:int,end:int,strict:boolean,pattern:int>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("strict", pa.bool_()), ("pattern", pa.int32())]))


def span_column(texts: pa.Array) -> pa.Array:
    names = ("kind", "start", "end", "strict", "pattern")
    return pa.array([[dict(zip(names, c, strict=True)) for c in candidates(t.as_py() or "")] for t in texts], SPAN_TYPE)


def proposed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, spans): all candidates of each text."""
    source = picked(docs, id=id_col, text=text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small(batches, 1000):
            yield pa.RecordBatch.from_arrays([batch.column("id"), span_column(batch.column("text"))], names=["id", "spans"])

    schema = T.StructType([T.StructField("id", source.schema["id"].dataType)]).add("spans", T.StructType.fromDDL(f"spans {SPANS}")["spans"].dataType)
    return source.mapInArrow(work, schema)


def trained(found: DataFrame) -> set[int]:
    """Patterns accepted by a classifier trained on all candidates of ``found`` (id, spans)."""
    patterns = found.select(F.explode("spans").alias("s")).groupBy("s.pattern").count()
    return classifier({r["pattern"]: r["count"] for r in patterns.collect()})  # at most PATTERNS rows


def accepted_spans(spans: list[dict], accepted: set[int]) -> list[tuple[int, int, int]]:
    return sorted((s["kind"], s["start"], s["end"]) for s in spans if s["strict"] or s["pattern"] in accepted)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the counts of base spans, the digest of their list, and the list of all spans."""
    found = settle(proposed(docs, id_col, text_col), "pii-candidates")
    accepted = found.sparkSession.sparkContext.broadcast(trained(found))  # at most PATTERNS numbers

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, shown = [], [], []
            for spans in batch.column("spans").to_pylist():
                base = sorted((s["kind"], s["start"], s["end"]) for s in spans if s["strict"])
                counts.append(np.bincount([k for k, _, _ in base], minlength=len(KINDS)))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                shown.append(joined(accepted_spans(spans, accepted.value)))
            numbers = np.array(counts, dtype=np.int64).reshape(-1, len(KINDS))
            columns = [batch.column("id"), *(pa.array(numbers[:, k]) for k in range(len(KINDS))), pa.array(digests, pa.string()), pa.array(shown, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType([found.schema["id"]])
    for kind in KINDS:
        schema = schema.add(f"n_{kind}", T.LongType())
    schema = schema.add("base_sha256", T.StringType()).add("spans", T.StringType())
    names = schema.names
    return found.mapInArrow(work, schema).withColumnRenamed("id", id_col)


def masked(text: str, spans: list[tuple[int, int, int]], mask: Callable[[str], str]) -> str:
    parts, at = [], 0
    for kind, begin, end in sorted(spans, key=lambda s: s[1]):
        if begin >= at:
            parts += [text[at:begin], mask(KINDS[kind])]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same table with every span replaced by its kind, as in ``<email>``; a null text stays null."""
    accepted = docs.sparkSession.sparkContext.broadcast(trained(proposed(docs, id_col, text_col)))
    place = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small(batches, 1000):
            texts = batch.column(place)
            clean = []
            for text in texts:
                whole = text.as_py()
                spans = [(k, a, b) for k, a, b, strict, p in candidates(whole or "") if strict or p in accepted.value]
                clean.append(masked(whole, spans, lambda kind: f"<{kind}>") if spans else whole)
            yield batch.set_column(place, batch.schema.field(place), pc.cast(pa.array(clean, pa.string()), texts.type))

    return docs.mapInArrow(work, docs.schema)

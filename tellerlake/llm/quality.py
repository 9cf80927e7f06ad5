"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. Its features are shares of kinds of characters, repetition,
word counts and lengths, cut at fixed steps, of the line itself and of the lines before and after it.
Forward-backward gives each line's probability to be good; a document's quality is the mean of
these, weighted by line length, mapped to the probability of label 1 by a one-dimensional logistic fit.

Training: only whole documents are labelled. Lines of good documents are good. Lines of bad
documents start as bad; then the field is fitted and bad documents' lines that it holds for good are
given up (the worst line of a bad document stays bad), a few times over. The fit uses at most
``TRAINING_DOCS`` labelled documents, as many of each label as there are up to half of that, the
first in a hash order, of at most ``TRAINING_LINES`` lines each; scoring reads whole texts of all documents.

Defined results: a null or empty text is one empty line; repeated rows get equal scores; a null id
counts as not held out; without labelled rows of both labels every score is the share of label 1
(0.5 without labels); an empty table gives no rows. Labels of null or of other values are not used,
and a document labelled twice counts with each label. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerlake.llm.common import column, in_small, picked

TRAINING_DOCS = 3000
TRAINING_LINES = 2000
ROUNDS = 3
STEPS = 80
RIDGE = 1e-3

LETTER, UPPER, DIGIT, SPACE, STOP, PIPE, SHOUT, OTHER = range(8)
KIND = np.full(256, OTHER, dtype=np.uint8)
for _b in range(256):
    _c = chr(_b)
    if _b >= 128 or "a" <= _c <= "z":
        KIND[_b] = LETTER
    elif "A" <= _c <= "Z":
        KIND[_b] = UPPER
    elif "0" <= _c <= "9":
        KIND[_b] = DIGIT
    elif _c.isspace():
        KIND[_b] = SPACE
    elif _c in ".,;:'-":
        KIND[_b] = STOP
    elif _c in "|\t":
        KIND[_b] = PIPE
    elif _c in "!?":
        KIND[_b] = SHOUT

# Each feature is "the measure is at least this".
CUTS: dict[str, tuple[float, ...]] = {
    "letters": (0.5, 0.7, 0.8, 0.9),
    "upper": (0.05, 0.1, 0.3, 0.6),
    "digits": (0.02, 0.1, 0.3),
    "pipes": (0.003, 0.02, 0.05),
    "shouts": (0.005, 0.02, 0.05),
    "others": (0.003, 0.01, 0.03, 0.1, 0.25),
    "repeats": (0.02, 0.1, 0.3, 0.6, 0.85),
    "distinct": (0.1, 0.2, 0.35, 0.6, 0.9),
    "words": (1, 2, 4, 8, 20, 60),
    "word_length": (3, 4.5, 6, 8, 12, 20),
    "ends": (0.5,),
    "copy": (0.5,),
    "first": (0.5,),
    "last": (0.5,),
}
FEATURES = 1 + sum(map(len, CUTS.values()))


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x FEATURES of 0 and 1, line lengths in bytes with the line's end)."""
    data = text.encode()
    raw = np.frombuffer(data + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.r_[0, ends[:-1] + 1]
    size = ends - starts + 1
    kind = KIND[raw]
    per = [np.add.reduceat(kind == k, starts, dtype=np.int64) for k in range(8)]
    body = np.maximum(size - 1, 1)
    lines = data.split(b"\n")
    words = np.empty(len(lines))
    distinct = np.empty(len(lines))
    repeats = np.empty(len(lines))
    for i, line in enumerate(lines):
        found = line.split()
        n = len(found)
        words[i] = n
        distinct[i] = len(set(found)) / n if n else 1
        repeats[i] = sum(map(eq, found, found[1:])) / (n - 1) if n > 1 else 0
    spaces = per[SPACE] - 1  # without the line's own end
    copy = np.array([a == b and a != b"" for a, b in zip(lines[1:], lines)], dtype=float)
    number = np.arange(len(lines))
    measures = {
        "letters": (per[LETTER] + per[UPPER] + spaces) / body,
        "upper": per[UPPER] / np.maximum(per[LETTER] + per[UPPER], 1),
        "digits": per[DIGIT] / body, "pipes": per[PIPE] / body, "shouts": per[SHOUT] / body, "others": per[OTHER] / body,
        "repeats": repeats, "distinct": distinct, "words": words, "word_length": (body - spaces) / np.maximum(words, 1),
        "ends": np.array([line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines]), "copy": np.r_[0.0, copy],
        "first": number == 0, "last": number == len(lines) - 1,
    }
    columns = [np.ones(len(lines))] + [measures[name] >= cut for name, cuts in CUTS.items() for cut in cuts]
    return np.stack(columns, axis=1).astype(np.float32), size


def with_neighbours(features: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and of the line after; ``begin`` marks first lines of documents."""
    before = np.roll(features, 1, axis=0)
    before[begin] = 0
    after = np.roll(features, -1, axis=0)
    after[np.r_[begin[1:] - 1, len(features) - 1]] = 0
    return np.hstack([features, before, after])


@dataclass
class Field:
    """Weights: ``line`` for a line's being good, ``turn[a, b]`` for label a followed by label b; ``slope``, ``shift`` of the final fit."""

    line: np.ndarray
    turn: np.ndarray
    slope: float = 1.0
    shift: float = 0.0


def log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(score: np.ndarray, turn: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all documents at once: P(good) per line, and expected counts of turns.

    ``score`` is the log weight of good against bad per line; step t handles the t-th line of all
    documents that have one.
    """
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    n, longest = len(score), int(size.max(initial=0))
    emit = np.stack([np.zeros(n), score], axis=1)
    fore, back = np.zeros((n, 2)), np.zeros((n, 2))
    active = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")  # documents with at least t + 1 lines
    for t in range(longest):
        at = begin[: active[t]] + t
        if t:
            last = fore[at - 1]
            fore[at] = emit[at] + log_sum(last[:, :1] + turn[0], last[:, 1:] + turn[1])
        else:
            fore[at] = emit[at]
    for t in range(longest - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        following = emit[at + 1] + back[at + 1]
        back[at] = log_sum(following[:, :1] + turn[:, 0], following[:, 1:] + turn[:, 1])
    total = fore + back
    good = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -60, 60)))
    inner = np.ones(n, dtype=bool)
    inner[begin + size - 1] = False
    at = np.flatnonzero(inner)
    norm = log_sum(total[at, 0], total[at, 1])
    pairs = fore[at][:, :, None] + turn[None] + (emit[at + 1] + back[at + 1])[:, None, :] - norm[:, None, None]
    return good, np.exp(pairs).sum(axis=0)


def fit_field(x: np.ndarray, label: np.ndarray, begin: np.ndarray, size: np.ndarray, weight: np.ndarray) -> Field:
    """Maximum likelihood of the line labels by Adam; ``weight`` balances documents' labels."""
    field, n = Field(np.zeros(x.shape[1]), np.zeros((2, 2))), len(x)
    inner = np.ones(n, dtype=bool)
    inner[begin + size - 1] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[at], label[at + 1]), 1)
    m, v = np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)
    for step in range(1, STEPS + 1):
        good, turns = marginals(x @ field.line, field.turn, begin, size)
        gradient = np.r_[x.T @ (weight * (label - good)) / weight.sum() - RIDGE * field.line, ((seen - turns) / n - RIDGE * field.turn).ravel()]
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        move = 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        field.line += move[:-4]
        field.turn += move[-4:].reshape(2, 2)
    return field


def raw_quality(field: Field, x: np.ndarray, begin: np.ndarray, size: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Length-weighted mean probability of good lines per document."""
    good, _ = marginals(x @ field.line, field.turn, begin, size)
    return np.add.reduceat(good * length, begin) / np.add.reduceat(length, begin)


def calibrated(field: Field, quality: np.ndarray) -> np.ndarray:
    z = field.slope * spread(quality) + field.shift
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def spread(quality: np.ndarray) -> np.ndarray:
    """Log odds, with the ends drawn in."""
    q = np.clip(quality, 0.001, 0.999)
    return np.log(q / (1 - q))


def fit(texts: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray) -> Field:
    """Field and final fit from (features, line lengths) and labels of documents."""
    size = np.array([len(f) for f, _ in texts])
    begin = np.r_[0, np.cumsum(size)[:-1]]
    x = with_neighbours(np.concatenate([f for f, _ in texts]), begin).astype(np.float64)
    length = np.concatenate([n for _, n in texts]).astype(float)
    doc = np.repeat(np.arange(len(size)), size)
    label = good[doc].astype(int)
    share = np.where(good, 0.5 / max(good.sum(), 1), 0.5 / max((~good).sum(), 1))
    weight = (share / size)[doc] * len(size)
    field = Field(np.zeros(x.shape[1]), np.zeros((2, 2)))
    for _ in range(ROUNDS):
        field = fit_field(x, label, begin, size, weight)
        alone = x @ field.line
        worst = np.minimum.reduceat(alone, begin)
        label = np.where(good[doc], 1, (alone > 0) & (alone > worst[doc])).astype(int)
    quality = spread(raw_quality(field, x, begin, size, length))
    field.slope, field.shift = platt(quality, good, share * len(size))
    return field


def platt(score: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and shift of a logistic fit by Newton's method, a little drawn to zero."""
    x = np.stack([score, np.ones(len(score))], axis=1)
    beta = np.array([0.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (weight * p * (1 - p))[:, None]) + 0.1 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (good - p)) - 0.1 * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def is_held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(column(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_set(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Line features and labels of the bounded training sample; features are worked out where the texts are."""
    known = picked(labels, id=id_col, label=label_col).filter(F.col("label").isin(0, 1) & ~is_held_out("id"))
    chosen = None
    for value in (0, 1):
        own = known.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(TRAINING_DOCS // 2)
        chosen = own if chosen is None else chosen.unionByName(own)
    sample = picked(docs, id=id_col, text=text_col).join(F.broadcast(chosen), "id")  # at most TRAINING_DOCS rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, sizes, kept = [], [], []
            for at, text in enumerate(batch.column("text")):
                whole = text.as_py() or ""
                if whole.count("\n") < TRAINING_LINES:
                    features, length = line_features(whole)
                    bits.append(np.packbits(features.astype(bool), axis=1).tobytes())
                    sizes.append(length.astype("<i8").tobytes())
                    kept.append(at)
            label = batch.column("label").take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([pc.cast(label, pa.int32()), pa.array(bits, pa.binary()), pa.array(sizes, pa.binary())], names=["label", "bits", "sizes"])

    rows = sample.select("text", "label").mapInArrow(work, "label int, bits binary, sizes binary").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["sizes"]), bytes(r["bits"])))
    wide = (FEATURES + 7) // 8
    texts = []
    for r in rows:
        packed = np.frombuffer(bytes(r["bits"]), dtype=np.uint8).reshape(-1, wide)
        texts.append((np.unpackbits(packed, axis=1, count=FEATURES).astype(np.float32), np.frombuffer(bytes(r["sizes"]), dtype="<i8")))
    return texts, np.array([r["label"] == 1 for r in rows], dtype=bool)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Field:
    texts, good = training_set(docs, labels, id_col, text_col, label_col)
    if good.all() or not good.any():
        share = float(np.clip(good.mean() if len(good) else 0.5, 0.001, 0.999))
        return Field(np.zeros(3 * FEATURES), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    return fit(texts, good)


def scored(docs: DataFrame, field: Field, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns and the score of each text."""
    place = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_small(batches, 1000):
            scores = np.empty(batch.num_rows)
            for first in range(0, batch.num_rows, 128):
                own = [line_features(t.as_py() or "") for t in batch.column(place)[first : first + 128]]
                size = np.array([len(f) for f, _ in own])
                begin = np.r_[0, np.cumsum(size)[:-1]]
                x = with_neighbours(np.concatenate([f for f, _ in own]), begin)
                length = np.concatenate([n for _, n in own]).astype(float)
                scores[first : first + 128] = calibrated(field, raw_quality(field, x, begin, size, length))  # a few hundred numbers, sent along
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """id, held_out, score and predicted (1 from ``threshold`` on) of every document."""
    field = train(docs, labels, id_col, text_col, label_col)
    found = scored(picked(docs, id=id_col, text=text_col), field)
    return found.select(
        F.col("id").alias(id_col), is_held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )

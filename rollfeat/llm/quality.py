"""A quality classifier: naive Bayes support vectors.

Features are indicators, hashed to 2**``BITS`` buckets, of word 1-grams, word 2-grams, byte 3-grams and 3-grams of word
shapes (letter case, length, trailing mark, repeat of the word before). An indicator is scaled by the log-count ratio of
its bucket between the two classes, a text's vector to length one. A linear model with hinge loss is fitted to these by
dual coordinate descent, with the classes weighed alike, and a logistic curve turns margins into probabilities.

Null and empty texts have no features and score by the intercept. Without labels of both classes every score is the
share of label 1 (0.5 without any).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollfeat.llm.text import as_bytes, constants, grams, mix, slices, word_hashes, words

BITS = 18
SAMPLE_ROWS = 8_000
EPOCHS = 20
COST = 1.0

_UNI, _BI, _SHAPES = constants("unigram", 1), constants("bigram", 2), constants("shapes", 3)
_DOWN = np.uint64(64 - BITS)
_MARKS = frozenset(b"!?.,;:|")


@dataclass(frozen=True)
class QualityModel:
    """Weight of each bucket (with its ratio), the squared ratios, intercept, and the curve."""

    weights: np.ndarray
    squares: np.ndarray
    intercept: float
    slope: float
    shift: float


def shape_hashes(found: list[bytes]) -> np.ndarray:
    shapes, before = np.empty(len(found), np.uint64), b""
    for i, w in enumerate(found):
        case = 1 if w.isupper() and len(w) > 1 else 2 if w.islower() else 3 if w.isalpha() else 4 if w.isdigit() else 0
        shapes[i] = case + 5 * min(len(w), 15) + 80 * (w[-1] in _MARKS) + 160 * (w == before)
        before = w
    return mix(shapes)


def buckets(texts: list[bytes | None]) -> list[np.ndarray]:
    """The distinct buckets of each text."""
    hashes, bounds = word_hashes(texts)
    seen = np.zeros(1 << BITS, bool)
    out = []
    for i, text in enumerate(texts):
        own = hashes[bounds[i] : bounds[i + 1]]
        letters = np.frombuffer(text or b"", np.uint8).astype(np.uint64)
        three = mix((letters[:-2] << np.uint64(16)) | (letters[1:-1] << np.uint64(8)) | letters[2:]) if len(letters) > 2 else np.empty(0, np.uint64)
        for found in (grams(own, _UNI), grams(own, _BI), grams(shape_hashes(words(text)), _SHAPES), three):
            seen[found >> _DOWN] = True
        at = np.flatnonzero(seen)
        seen[at] = False
        out.append(at.astype(np.int32))
    return out


def descend(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of the linear model with hinge loss, by dual coordinate descent in a fixed random order."""
    cost = np.where(y > 0, COST * len(y) / (2 * max((y > 0).sum(), 1)), COST * len(y) / (2 * max((y < 0).sum(), 1)))
    values = [ratios[r] / max(np.sqrt((ratios[r] ** 2).sum()), 1e-9) for r in rows]
    square = np.array([(v**2).sum() for v in values]) + 1.0
    weights, intercept, dual = np.zeros(len(ratios)), 0.0, np.zeros(len(y))
    random = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in random.permutation(len(y)):
            gradient = y[i] * (weights[rows[i]] @ values[i] + intercept) - 1.0
            new = min(max(dual[i] - gradient / square[i], 0.0), cost[i])
            if new != dual[i]:
                step = (new - dual[i]) * y[i]
                weights[rows[i]] += step * values[i]
                intercept += step
                dual[i] = new
    return weights, intercept


def curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through margins, by Newton's method with a little shrinkage."""
    slope, shift = 1.0, 0.0
    target = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        weight = np.maximum(p * (1 - p), 1e-6)
        gradient = np.array([((p - target) * margins).sum() + 1e-2 * slope, (p - target).sum()])
        hessian = np.array([[(weight * margins**2).sum() + 1e-2, (weight * margins).sum()], [(weight * margins).sum(), weight.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        slope, shift = slope - step[0], shift - step[1]
        if abs(step).max() < 1e-8:
            break
    return max(float(slope), 1e-3), float(shift)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Learn from ``labels`` (``doc_id``, ``quality`` 0 or 1), at most about ``sample_rows`` of them.

    The sample is all rows below a bound on a hash of ``doc_id``; the bound follows from the number of labels. Its ids are
    broadcast, so no text is shuffled, and its features come to the driver. A fifth of it only sets the curve.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = known.count()
    share = min(1.0, sample_rows / max(n, 1))
    hashed = F.xxhash64(F.col("doc_id").cast("long"), F.lit("quality sample"))
    sample = known.where(hashed <= F.lit(-(2.0**63) + share * 2.0**64)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def read(batches):
        for batch in slices(batches, "text"):
            packed = [b.tobytes() for b in buckets(as_bytes(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(packed, pa.binary())], ["doc_id", "quality", "buckets"])

    got = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text").mapInArrow(read, "doc_id long, quality int, buckets binary").collect()
    got = sorted({(r["doc_id"], r["quality"], bytes(r["buckets"])) for r in got})
    rows = [np.frombuffer(b, np.int32) for _, _, b in got]
    y = np.array([1 if q == 1 else -1 for _, q, _ in got])
    if len(set(y.tolist())) < 2:
        share = float((y > 0).mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return QualityModel(np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 1.0, float(np.log(share / (1 - share))))
    aside = np.arange(len(y)) % 5 == 4
    if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
        aside = np.zeros(len(y), bool)
    learned = [r for r, a in zip(rows, aside) if not a]
    side = y[~aside]
    counts = {c: np.ones(1 << BITS) for c in (-1, 1)}
    for r, c in zip(learned, side.tolist()):
        counts[c][r] += 1
    ratios = np.log(counts[1] / ((side > 0).sum() + 2)) - np.log(counts[-1] / ((side < 0).sum() + 2))
    weights, intercept = descend(learned, side, ratios)
    model = QualityModel(weights * ratios, ratios**2, intercept, 1.0, 0.0)
    tested = [r for r, a in zip(rows, aside) if a] or rows
    slope, shift = curve(np.array([margin(r, model) for r in tested]), y[aside] if aside.any() else y)
    return QualityModel(model.weights, model.squares, intercept, slope, shift)


def margin(found: np.ndarray, model: QualityModel) -> float:
    return float(model.weights[found].sum() / max(np.sqrt(model.squares[found].sum()), 1e-9) + model.intercept)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """All columns of ``docs``, and ``score``: the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = [c for c in docs.columns if c != "score"]
    schema = T.StructType([docs.schema[c] for c in own] + [T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in slices(batches, "text"):
            margins = np.array([margin(b, shared.value) for b in buckets(as_bytes(batch.column("text")))])
            found = 1 / (1 + np.exp(-np.clip(shared.value.slope * margins + shared.value.shift, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(found, pa.float64())], [*own, "score"])

    return docs.select(*[F.col(f"`{c}`") for c in own]).mapInArrow(run, schema)

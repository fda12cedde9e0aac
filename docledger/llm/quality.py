"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams, one and two words long, over two alphabets:
the words themselves and their shapes (case, digits, marks at the end, a repeat
of one of the words before). They are hashed into buckets. Each indicator is scaled by the
logarithm of the ratio of its class counts, then a linear model with hinge loss
is fitted by dual coordinate descent, and a logistic curve on held-back rows
turns its margin into a score.

The model is fitted on about ``PER_CLASS`` labelled rows of each class, whole
texts, picked by a hash of their id; the driver gets their buckets, at most
``BUCKETS`` a text. The picked ids are the only thing that is broadcast.
Scoring is one pass of the table without any shuffle.

Defined results: null and empty texts have no feature and get the score of the
model's constant; null labels are not learned, contradicting ones are each
learned; with no label at all the score is 0.5, with one class it is that
class. Repeated rows score alike; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.llm.words import mixed, word_hashes

BUCKETS = 1 << 16
PER_CLASS = 3_000
SMOOTHING = 1.0
COST = 0.1
EPOCHS = 10
LOOK_BACK = 8


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A small number for each word: how it is written, and whether it repeats a word before."""
    byte = data.astype(np.int64)
    sums = lambda test: np.concatenate(([0], np.cumsum(test)))
    upper = sums((byte >= 65) & (byte <= 90))
    lower = sums((byte >= 97) & (byte <= 122))
    digit = sums((byte >= 48) & (byte <= 57))
    high = sums(byte >= 128)
    length = ends - starts
    count = lambda s: s[ends] - s[starts]
    ups, lows, digits, highs = count(upper), count(lower), count(digit), count(high)
    marks = length - ups - lows - digits - highs
    shape = np.minimum(ups, 2) + 3 * np.minimum(lows, 1) + 6 * np.minimum(digits, 1) + 12 * np.minimum(marks, 3)
    last = byte[ends - 1]
    shape = shape * 128 + np.where((last < 48) | ((last > 57) & (last < 65)), last, 0)
    repeat = np.zeros(len(words), dtype=np.int64)
    for back in range(1, min(LOOK_BACK, len(words) - 1) + 1):
        same = words[back:] == words[:-back]
        repeat[back:] = np.where(same & (repeat[back:] == 0), 1 + (back > 1), repeat[back:])
    return (shape * 4 + repeat).astype(np.uint64)


def features(text: str | None) -> np.ndarray:
    """Buckets of the n-grams of a text, each once."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    starts, ends, words = word_hashes(data)
    if not len(words):
        return np.empty(0, dtype=np.int32)
    shapes = _shapes(data, starts, ends, words)
    two = np.uint64(0x100000001B3)
    grams = [words, words[:-1] * two + words[1:] + np.uint64(1)]
    grams += [shapes + np.uint64(2) * two, shapes[:-1] * two * two + shapes[1:] + np.uint64(3)]
    hashed = mixed(np.concatenate(grams)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    seen = np.zeros(BUCKETS, dtype=bool)
    seen[hashed.astype(np.int64)] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, at: np.ndarray) -> float:
        margin = float(self.weights[at].sum() / np.sqrt(max(1, len(at)))) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def _descend(rows: list[np.ndarray], signs: np.ndarray, ratio: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; rows are scaled indicators, and a constant 1."""
    weights, bias, duals = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    values = [ratio[at] / np.sqrt(max(1, len(at))) for at in rows]
    norms = [float(v @ v) + 1.0 for v in values]
    cost = {s: COST * len(rows) / (2 * max(1, int((signs == s).sum()))) for s in (-1, 1)}  # classes weigh alike
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, value, sign = rows[i], values[i], int(signs[i])
            slope = sign * (weights[at] @ value + bias) - 1
            dual = min(max(duals[i] - slope / norms[i], 0.0), cost[sign])
            if dual != duals[i]:
                step = (dual - duals[i]) * sign
                weights[at] += step * value
                bias += step
                duals[i] = dual
    return weights * ratio, bias


def _logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a slight pull to 1 and 0."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -50, 50)))
        w, e = p * (1 - p), p - good
        h = np.array([[(w * margins**2).sum() + 1e-2, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(h, np.array([(e * margins).sum() + 1e-2 * (a - 1), e.sum() + 1e-2 * b]))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def train(samples: list[tuple[int, np.ndarray]], seed: int = 11) -> QualityModel:
    """``samples``: label (0 or 1) and buckets; every fifth is held back for the logistic curve."""
    zero = np.zeros(BUCKETS)
    good = np.array([label for label, _ in samples])
    if not len(good) or good.min() == good.max():
        return QualityModel(zero, 0.0, 0.0, 0.0 if not len(good) else (20.0 if good[0] else -20.0))
    held = np.arange(len(samples)) % 5 == 0
    if len(samples) < 50 or len(set(good[~held])) < 2:
        held[:] = False
    used = [at for (_, at), h in zip(samples, held, strict=True) if not h]
    signs = np.where(good[~held] == 1, 1, -1)
    counts = {s: np.full(BUCKETS, SMOOTHING) for s in (-1, 1)}
    for at, s in zip(used, signs, strict=True):
        counts[int(s)][at] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[-1] / counts[-1].sum())
    weights, bias = _descend(used, signs, ratio, seed)
    model = QualityModel(weights, bias, 1.0, 0.0)
    tested = [(label, at) for (label, at), h in zip(samples, held, strict=True) if h] or samples
    margins = np.array([weights[at].sum() / np.sqrt(max(1, len(at))) + bias for _, at in tested])
    slope, offset = _logistic(margins, np.array([label for label, _ in tested], dtype=float))
    return QualityModel(model.weights.astype(np.float32), bias, slope, offset)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(text.as_py()) for text in batch.column("text")]
        yield pa.RecordBatch.from_pydict(
            {
                "label": batch.column("label"),
                "order": batch.column("order"),
                "buckets": pa.array(found, type=pa.list_(pa.int32())),
            }
        )


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, per_class: int = PER_CLASS, seed: int = 11) -> QualityModel:
    """Learn from labelled rows for which ``may_learn`` (a condition on doc_id) holds."""
    known = labels.where(may_learn & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if not counts:
        return train([])
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    share = F.when(F.col("quality") == 1, min(1.0, per_class / counts.get(1, 1))).otherwise(min(1.0, per_class / counts.get(0, 1)))
    picked = known.where((F.pmod(order, F.lit(1 << 30)) / float(1 << 30)) < share).select(
        F.col("doc_id").alias("picked_id"), F.col("quality").cast("int").alias("label"), order.alias("order")
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("picked_id"))
    rows = (
        sample.select("label", "order", "text")
        .mapInArrow(_featured, "label int, order long, buckets array<int>")
        .toArrow()
        .sort_by([("order", "ascending"), ("label", "ascending")])
    )
    return train([(label, at.values.to_numpy()) for label, at in zip(rows["label"].to_pylist(), rows["buckets"], strict=True)])


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(features(text.as_py())) for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(found, pa.float64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double")

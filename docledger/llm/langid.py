"""Language identification: averaged hashed subword embeddings and a linear softmax.

Letters keep their lower case, everything else is a word edge; n-grams of two
and three characters are hashed into buckets. A text's vector is the average of
its buckets' embeddings; a linear layer and softmax follow. Embeddings and layer
are trained by stochastic gradient descent in numpy, on a sample of labelled
documents that holds about ``per_label`` documents of each label, whole texts.
What the driver gets of a sampled text are the counts of its buckets, at most
``BUCKETS`` of them, so its memory is bounded.

A fifth of the sample trains nothing: it sets the temperature that makes the
probabilities honest, and the least probability a prediction must have to be
accepted: low enough to accept all but ``alpha`` of the held-back documents that
were right, and never above one half.

Prediction is one pass of the table without any shuffle. As averaging and the
layer are both linear, they fold into one table of a score per bucket and label.

Defined results: null texts and texts without a letter are ``und`` with score 0
and are rejected; without any labelled document all are; with one label all
others are that label. Null labels are not learned. Repeated rows are predicted
alike. Very long texts are read in stretches. Further columns are ignored, or
kept where rows are filtered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.llm.words import with_room

BUCKETS = 1 << 15
DIMENSIONS = 16
PER_LABEL = 400
MOST_LABELS = 1_000
EPOCHS = 12
ALPHA = 0.002
STRETCH = 1 << 20
UNKNOWN = "und"

_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTERS


def subwords(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, a stretch at a time; nothing if it has no letter."""
    letters = _letters()
    lower = text.lower()
    for start in range(0, len(lower), STRETCH):
        part = lower[max(0, start - 2) : start + STRETCH]
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = letters[code]
        if not is_letter.any():
            continue
        code = np.concatenate((np.zeros(1, np.uint32), np.where(is_letter, code, np.uint32(0)), np.zeros(1, np.uint32)))
        known = code > 0
        two = code[:-1] * np.uint32(0x9E3779B1) + code[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0xC2B2AE3D) + code[2:] * np.uint32(0x27D4EB2F)
        any_two = known[:-1] | known[1:]
        shift = np.uint32(32 - BUCKETS.bit_length() + 1)
        mixed = np.concatenate((two[any_two], three[known[1:-1]]))
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        yield (mixed >> shift).astype(np.int32)


def bucket_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for part in subwords(text or ""):
        counts += np.bincount(part, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


@with_room
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [bucket_counts(text) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {
                "label": batch.column("label"),
                "order": batch.column("order"),
                "buckets": pa.array([at.astype(np.int32) for at, _ in found], type=pa.list_(pa.int32())),
                "counts": pa.array([n.astype(np.float32) for _, n in found], type=pa.list_(pa.float32())),
            }
        )


@dataclass(frozen=True)
class LanguageModel:
    labels: tuple[str, ...]
    table: np.ndarray  # score of a bucket for a label
    bias: np.ndarray
    temperature: float
    least: float

    def probabilities(self, text: str | None) -> np.ndarray | None:
        """Calibrated probability of each label; None for a text without a letter."""
        total, seen = np.zeros(len(self.labels)), 0
        for part in subwords(text or ""):
            seen += len(part)
            total += np.bincount(part, minlength=BUCKETS) @ self.table if len(part) > BUCKETS // 4 else self.table[part].sum(axis=0, dtype=np.float64)
        if not seen or not self.labels:
            return None
        return _softmax((total / seen + self.bias) / self.temperature)


def _softmax(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return grown / grown.sum(axis=-1, keepdims=True)


def train(samples: list[tuple[str, np.ndarray, np.ndarray]], alpha: float = ALPHA, seed: int = 7) -> LanguageModel:
    """``samples``: label, buckets and counts; every fifth is held back for calibration."""
    labels = tuple(sorted({s[0] for s in samples}))
    samples = [s for s in samples if len(s[1])]
    if not samples:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    place = {label: i for i, label in enumerate(labels)}
    held = samples[::5] if len(samples) >= 10 * len(labels) else samples
    used = [s for i, s in enumerate(samples) if i % 5] if held is not samples else samples
    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, len(labels))), np.zeros(len(labels))
    steps, done = EPOCHS * len(used), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(used)):
            label, at, counts = used[i]
            rate = 0.5 * (1 - done / steps)
            share = counts / counts.sum()
            hidden = share @ embedding[at]
            slope = _softmax(hidden @ layer + bias)
            slope[place[label]] -= 1
            back = layer @ slope
            layer -= rate * np.outer(hidden, slope)
            bias -= rate * 0.1 * slope
            embedding[at] -= rate * 20 * np.outer(share, back)
            done += 1
    table = embedding @ layer
    scores = np.array([s[2] / s[2].sum() @ table[s[1]] + bias for s in held])
    truth = np.array([place[s[0]] for s in held])
    rows = np.arange(len(held))
    loss = {t: -np.log(np.maximum(_softmax(scores / t)[rows, truth], 1e-12)).mean() for t in np.geomspace(0.05, 20, 60)}
    temperature = float(min(loss, key=loss.get))
    calibrated = _softmax(scores / temperature)
    right = calibrated.max(axis=1)[calibrated.argmax(axis=1) == truth]
    least = min(0.5, float(np.quantile(right, alpha)) if len(right) else 0.5)
    return LanguageModel(labels, table.astype(np.float32), bias, temperature, least)


def fit(docs: DataFrame, may_learn: Column, per_label: int = PER_LABEL, seed: int = 7) -> LanguageModel:
    """Learn from rows for which ``may_learn`` holds and whose lang is not null.

    Labels are counted over all rows; a hash of the id then picks about
    ``per_label`` documents of each label. More labels than ``MOST_LABELS`` are an error.
    """
    learnable = docs.where(may_learn & F.col("lang").isNotNull())
    counts = learnable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LABELS + 1).collect()
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels; a model of {BUCKETS} buckets a label would outgrow a task")
    if not counts:
        return train([])
    share = F.element_at(F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, per_label / r["count"])))]), F.col("lang"))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    picked = learnable.where((F.pmod(order, F.lit(1 << 30)) / float(1 << 30)) < share)
    counted = picked.select(F.col("lang").alias("label"), order.alias("order"), "text").mapInArrow(
        _counted, "label string, order long, buckets array<int>, counts array<float>"
    )
    rows = counted.toArrow().sort_by([("order", "ascending"), ("label", "ascending")])
    samples = [
        (label, at.values.to_numpy().astype(np.int64), n.values.to_numpy().astype(np.float64))
        for label, at, n in zip(rows["label"].to_pylist(), rows["buckets"], rows["counts"], strict=True)
    ]
    return train(samples)


def _predicted(model: LanguageModel, extra: list[str]):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores, accepted = [], [], []
            for text in batch.column("text"):
                p = model.probabilities(text.as_py())
                best = None if p is None else int(p.argmax())
                labels.append(UNKNOWN if p is None else model.labels[best])
                scores.append(0.0 if p is None else min(1.0, float(p[best])))
                accepted.append(p is not None and p[best] >= model.least)
            yield pa.RecordBatch.from_pydict(
                {name: batch.column(name) for name in extra}
                | {"lang_pred": pa.array(labels, pa.string()), "score": pa.array(scores, pa.float64()), "accepted": pa.array(accepted, pa.bool_())}
            )

    return predict


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score and accepted of every document."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, accepted boolean"
    return docs.select("doc_id", "text").mapInArrow(_predicted(model, ["doc_id"]), schema)


def accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents whose language the model accepts, with the columns they came with.

    A predicate goes to Python and back with the text alone; the rows stay where they are.
    """
    accepts = F.arrow_udf(_accepts(model), "boolean")
    return docs.where(accepts(F.coalesce(docs["text"], F.lit(""))))


def _accepts(model: LanguageModel):
    @with_room
    def accepts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = (model.probabilities(text.as_py()) for text in texts)
            yield pa.array([p is not None and bool(p.max() >= model.least) for p in found], pa.bool_())

    accepts.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return accepts

"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text is shared by all grades, and ordered thresholds cut its score: the probability of a
grade above ``k`` is ``sigmoid(w.x - threshold[k])``. Thresholds stay ordered because only the first one and the logarithms
of the gaps are learned. The model gives the expected grade, for ranking, and the tail probability of a grade of at least
``least_grade``, for selection.

Features are the distinct words of a text, as in a bag, and the shares of word shapes (letters by case, digits, marks,
runs of one kind shortened), of pairs of shapes and of words that repeat the word before, all hashed into ``2 ** bits``
places. Learning goes through a bounded sample of labelled documents (``documents``, outside the held-out fold) in one
task; the weights are broadcast, and scoring is a map over whole texts.

Grades come from the labels: 0 is low quality, 1 is good but toxic text, 2 is good.

Defined cases: a null or empty text has no features and gets the thresholds' own probabilities; a null id is scored and
not held out; labels without quality are not learned from, and a null toxic mark counts as none; without labels the model
knows nothing and keeps every row; repeated rows get equal scores, repeated labels count once, the highest of them; very
long texts are worked on one by one, at about 60 bytes a word; an empty table gives an empty table; other columns are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.frames import inputs
from cohortloom.llm.hashed_text import Hashes, held_out, labelled_sample, paired, plain_words

GRADES = 3
_WORDS, _SHAPES = Hashes(), Hashes()
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)
_KINDS = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)


@dataclass(frozen=True)
class Settings:
    documents: int = 12_000
    bits: int = 18
    rounds: int = 3
    rate: float = 0.15
    l2: float = 1e-5
    least_grade: int = 1
    least_probability: float = 0.5


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """For each score and threshold, the probability of a grade above it."""
        return sigmoid(scores[:, None] - self.thresholds[None, :])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def features(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and their values; the values of words, and those of shapes, have length one each."""
    raw = text.encode()
    places, values = [], []
    words = np.unique(_WORDS.of(plain_words(text)))
    if len(words):
        places.append(words)
        values.append(np.full(len(words), len(words) ** -0.5))
    tokens = raw.split()
    if tokens:
        shapes = _SHAPES.of(_RUNS.sub(rb"\1", raw.translate(_KINDS)).split())
        same = sum(a == b for a, b in zip(tokens, tokens[1:], strict=False))
        kinds, counts = np.unique(np.concatenate([shapes, paired(shapes[:-1], shapes[1:], 3)]), return_counts=True)
        marks = paired(np.append(kinds, np.uint64(7)), np.full(len(kinds) + 1, 11, "uint64"), 4)
        share = np.append(counts, same) / len(tokens)
        places.append(marks)
        values.append(share / np.linalg.norm(share))
    if not places:
        return np.zeros(0, "int64"), np.zeros(0, "float32")
    at = (np.concatenate(places) >> np.uint64(64 - bits)).astype("int64")
    return at, np.concatenate(values).astype("float32")


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Adaptive gradient steps on the likelihood of the grades, row by row."""
    weights, seen = np.zeros(1 << settings.bits), np.full(1 << settings.bits, 1e-6)
    # First threshold, then the logarithms of the gaps.
    free, free_seen = np.array([-1.0] + [0.0] * (GRADES - 2)), np.full(GRADES - 1, 1e-6)
    for _ in range(settings.rounds):
        for places, values, grade in rows:
            gaps = np.exp(free[1:])
            thresholds = free[0] + np.concatenate([[0.0], np.cumsum(gaps)])
            score = float(weights[places] @ values)
            # P(grade) = F(upper - score) - F(lower - score), with F the sigmoid and infinite outer thresholds.
            upper = sigmoid(np.array(thresholds[grade] - score)) if grade < GRADES - 1 else 1.0
            lower = sigmoid(np.array(thresholds[grade - 1] - score)) if grade else 0.0
            chance = max(float(upper - lower), 1e-9)
            d_upper, d_lower = float(upper * (1 - upper)) / chance, float(lower * (1 - lower)) / chance
            slope = (d_upper - d_lower) * values + settings.l2 * weights[places]
            seen[places] += slope**2
            weights[places] -= settings.rate * slope / np.sqrt(seen[places])
            pull = np.zeros(GRADES - 1)
            if grade < GRADES - 1:
                pull[grade] -= d_upper
            if grade:
                pull[grade - 1] += d_lower
            step = np.cumsum(pull[::-1])[::-1].copy()
            step[1:] *= gaps
            free_seen += step**2
            free -= settings.rate * step / np.sqrt(free_seen)
    thresholds = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
    return Model(weights.astype("float32"), thresholds)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(toxic, 1).otherwise(2))
    sample = labelled_sample(docs, inputs(labels, "doc_id", "quality", "toxic"), grade, settings.documents)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, settings.bits) for t in batch.column("text").to_pylist()]
            columns = [batch.column("place"), batch.column("label")]
            columns += [pa.array([f[k].astype(d).tobytes() for f in found], pa.binary()) for k, d in ((0, "<u4"), (1, "<f4"))]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "label", "places", "parts"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for _, grade, places, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.append((np.frombuffer(places, "<u4").astype("int64"), np.frombuffer(parts, "<f4"), grade))
        if rows:
            model = fit(rows, settings)
            at = np.flatnonzero(model.weights)
            places = np.concatenate([at, -1 - np.arange(GRADES - 1)])
            values = np.concatenate([model.weights[at], model.thresholds])
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(values)], names=["place", "value"])

    schema = "place long, label int, places binary, parts binary"
    sets = sample.select("place", "label", "text").mapInArrow(featured, schema)
    # One task sees the bounded sample, in an order that does not depend on the cluster.
    ordered = sets.repartition(1).sortWithinPartitions("place")
    rows = ordered.mapInArrow(fitted, "place long, value double").toPandas()  # at most 2 ** bits rows
    weights = np.zeros(1 << settings.bits, "float32")
    thresholds = np.full(GRADES - 1, -35.0)
    at, values = rows["place"].to_numpy("int64"), rows["value"].to_numpy("float64")
    weights[at[at >= 0]] = values[at >= 0]
    thresholds[-1 - at[at < 0]] = values[at < 0]
    return Model(weights, thresholds)


def score(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, held_out, expected_grade, tail_probability, kept)`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            sums = []
            for text in batch.column("text").to_pylist():
                places, values = features(text or "", settings.bits)
                sums.append(float(own.weights[places].astype("float64") @ values))
            above = own.above(np.array(sums, "float64"))
            tail = above[:, settings.least_grade - 1]
            columns = [batch.column("doc_id"), pa.array(above.sum(axis=1)), pa.array(tail)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "expected_grade", "tail_probability"])

    given = inputs(docs, "doc_id", "text")
    rows = given.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double")
    kept = F.col("tail_probability") >= settings.least_probability
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_probability", kept.alias("kept")
    )

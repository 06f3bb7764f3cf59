"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashes of a text's words, of neighbouring pairs and of pairs with one word between, in
``2 ** bits`` places; single words also count by their first letters, so that inflected words are known by their stems. Learning goes through a bounded sample of labelled documents (``documents``, outside the held-out fold) in a fixed
order, in one task: each coordinate has its own rate, which falls with the gradients it has seen, and the L1 term keeps
coordinates at zero until there is evidence. The weights that are left, a few tens of thousands at most, are broadcast;
scoring is a map over whole texts.

Defined cases: a null or empty text has no features and scores the bias; a null id is scored and not held out; documents
without a label, and null labels, are not learned from; without labels of both kinds every score is the share of ones,
zero if there are none; repeated rows get equal scores, repeated labels count once, the highest of them; very long texts
are worked on one by one, at about 60 bytes a word; an empty table gives an empty table; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.frames import inputs
from cohortloom.llm.hashed_text import StemHashes, held_out, labelled_sample, paired, plain_words

_HASHES = StemHashes()


@dataclass(frozen=True)
class Settings:
    documents: int = 16_000
    bits: int = 20
    rounds: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 1.0


@dataclass
class Weights:
    """``places`` ascending, their ``values``, and the bias."""

    places: np.ndarray
    values: np.ndarray
    bias: float

    def dense(self, bits: int) -> np.ndarray:
        out = np.zeros(1 << bits, "float32")
        out[self.places] = self.values
        return out


def features(text: str, bits: int) -> np.ndarray:
    """Places of a text's n-grams and skip-grams, repeats included."""
    hashes = _HASHES.of(plain_words(text))
    words = hashes[:, 0]
    grams = [hashes.ravel(), paired(words[:-1], words[1:], 1), paired(words[:-2], words[2:], 2)]
    return (np.concatenate(grams) >> np.uint64(64 - bits)).astype("int64")


class Ftrl:
    """Follow the regularized leader, with per-coordinate rates."""

    def __init__(self, settings: Settings) -> None:
        self.s = settings
        self.z = np.zeros((1 << settings.bits) + 1)  # the last place is the bias
        self.n = np.zeros((1 << settings.bits) + 1)

    def weights(self, places: np.ndarray) -> np.ndarray:
        s, z = self.s, self.z[places]
        l1 = np.where(places == len(self.z) - 1, 0.0, s.l1)
        rate = (s.beta + np.sqrt(self.n[places])) / s.alpha + s.l2
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / rate)

    def learn(self, places: np.ndarray, label: int) -> None:
        """``places``: distinct features; the bias is added here."""
        places = np.append(places, len(self.z) - 1)
        w = self.weights(places)
        gradient = sigmoid(w.sum()) - label
        n = self.n[places]
        self.z[places] += gradient - (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.s.alpha * w
        self.n[places] = n + gradient**2

    def result(self) -> Weights:
        values = self.weights(np.arange(len(self.z)))
        places = np.flatnonzero(values[:-1])
        return Weights(places, values[places].astype("float32"), float(values[-1]))


def sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Weights:
    sample = labelled_sample(docs, inputs(labels, "doc_id", "toxic"), F.col("toxic"), settings.documents)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(features(t, settings.bits)).astype("<u4") for t in batch.column("text").to_pylist()]
            columns = [batch.column("place"), batch.column("label"), pa.array([f.tobytes() for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "label", "features"])

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            sets = [np.frombuffer(f, "<u4") for f in batch.column("features").to_pylist()]
            rows += zip(sets, batch.column("label").to_pylist(), strict=True)
        model = Ftrl(settings)
        ones = sum(label for _, label in rows)
        if 0 < ones < len(rows):
            for _ in range(settings.rounds):
                for places, label in rows:
                    model.learn(places.astype("int64"), label)
            result = model.result()
        else:
            share = min(max(ones / len(rows), 1e-15), 1 - 1e-15)
            result = Weights(np.zeros(0, "int64"), np.zeros(0, "float32"), float(np.log(share / (1 - share))))
        columns = [np.append(result.places, -1), np.append(result.values, result.bias).astype("float64")]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["place", "value"])

    sets = sample.select("place", "label", "text").mapInArrow(featured, "place long, label int, features binary")
    # One task sees the bounded sample, in an order that does not depend on the cluster.
    fitted = sets.repartition(1).sortWithinPartitions("place")
    rows = fitted.mapInArrow(learned, "place long, value double").toPandas()
    if not len(rows):
        return Weights(np.zeros(0, "int64"), np.zeros(0, "float32"), -35.0)
    at = rows["place"].to_numpy()
    values = rows["value"].to_numpy()
    return Weights(at[at >= 0], values[at >= 0].astype("float32"), float(values[at < 0][0]))


def score(docs: DataFrame, weights: Weights, settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, held_out, score)`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, bias = sent.value.dense(settings.bits), sent.value.bias
        for batch in batches:
            sums = []
            for text in batch.column("text").to_pylist():
                places = features(text or "", settings.bits)
                places = np.unique(places[dense[places] != 0])
                sums.append(bias + float(dense[places].sum(dtype="float64")))
            columns = [batch.column("doc_id"), pa.array(sigmoid(np.array(sums, "float64")))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score"])

    given = inputs(docs, "doc_id", "text")
    rows = given.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")

"""What the text classifiers share: words as hashes, and bounded samples of labelled documents."""

from __future__ import annotations

import string

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.frames import inputs

#: Words a worker remembers the hashes of; about 150 bytes each.
CACHE = 300_000
FOLDS = 4
HELD_OUT = 2
_SPACED = bytes(b if chr(b) not in string.punctuation and b >= 32 else 32 for b in range(256))


#: Lengths, in letters, of the beginnings of words that count as words of their own: inflected words share them.
STEMS = (4, 5)


class Hashes(dict):
    """Hashes of byte strings, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, 1)
        if len(self) < CACHE:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), "uint64", len(words))


class StemHashes(dict):
    """For each word its hash and those of its beginnings, as bytes, remembered up to a bound."""

    def __missing__(self, word: bytes) -> bytes:
        letters = word.decode()
        hashes = [xxhash.xxh64_intdigest(word, 1), *(xxhash.xxh64_intdigest(letters[:n], 100 + n) for n in STEMS)]
        value = np.array(hashes, "uint64").tobytes()
        if len(self) < CACHE:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        """One row a word: the word itself first."""
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "uint64").reshape(-1, 1 + len(STEMS))


def plain_words(text: str) -> list[bytes]:
    """Lower-case words in UTF-8, ASCII punctuation and control characters taken as white space."""
    return text.lower().encode().translate(_SPACED).split()


def paired(first: np.ndarray, second: np.ndarray, kind: int) -> np.ndarray:
    """A hash for each pair of hashes; ``kind`` keeps kinds of pairs apart."""
    with np.errstate(over="ignore"):
        x = (first * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind)) ^ (second * np.uint64(0xC2B2AE3D27D4EB4F))
        return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from learning. False without id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, most: int) -> DataFrame:
    """``(doc_id, text, label, place)`` of about ``most`` labelled documents outside the held-out fold, or of all.

    Documents are chosen by a hash of their id, whatever the corpus's size, so reruns and lost tasks choose the same. Of
    several labels of one document the highest counts, of several texts the first in code point order.
    """
    ids = F.col("doc_id").cast("long").alias("doc_id")
    given = labels.select(ids, label.cast("int").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    given = given.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 40))
    share = min(1.0, most / max(given.count(), 1))
    chosen = given.withColumn("place", place).where(F.col("place") < round(share * (1 << 40)))
    texts = inputs(docs, "doc_id", "text").select(ids, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # About ``most`` rows of 20 bytes, however large the tables.
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "place")
    return found.agg(F.min("text").alias("text"))

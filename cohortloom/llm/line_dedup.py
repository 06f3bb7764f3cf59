"""Line dedup: sharded minimal perfect hashes over line hashes, whose arrays the documents probe.

1. **Line keys.** A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least ``shortest``
   code points are hashed to 128 bits; a document sends each of its keys once, as a row of fixed width.
2. **Index.** Keys are counted by a partial aggregate that keeps the smallest and the largest document; only keys of two
   or more documents are indexed. Each shard of them gets a minimal perfect hash (levels of bits, in which keys that
   share a place go on to the next level) and, in its order, arrays of 64-bit fingerprints, counts and first documents.
3. **Probes.** A document's keys go to their shard as rows of fixed width and are looked up there, all at once, in the
   arrays. Lines and texts are never joined. Keys frequent enough to weigh on a shard are few (at most ``4 * shards``);
   they are written as a table of their own and joined, by a broadcast while their bytes allow it.
4. **Texts.** Only documents that lose lines are split again, next to the keys they lose. A Bloom filter of fixed size settles
   the others where they are read, so that no text is shuffled but of documents that lose lines and of a few that might.

Very long texts are split one by one, at about ten times their bytes in memory.

Defined cases: a null text is one empty line, like an empty one; a null id counts as one document after all others; rows
that share an id are one document, so their common lines are kept in each; a document that loses all lines keeps an empty
text; an empty table gives an empty table; other columns are passed through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.frames import packed, partitions, staged
from cohortloom.operators.duplicates import bloom_filter, bloom_mask, bloom_slot

SHORTEST = 10
#: Keys of a shard at most, on average; a shard's arrays take about 21 bytes a key.
SHARD_KEYS = 500_000
#: Words of the Bloom filter of documents that lose lines, about 50 bytes each when broadcast.
FILTER_WORDS = 1 << 18
LAST_ID = (1 << 63) - 1
_WHITE = b" \t\n\x0b\x0c\r"
_GOLDEN = 0x9E3779B97F4A7C15


def line_keys(text: str, shortest: int = SHORTEST) -> list[bytes | None]:
    """The 16-byte hash of each line's key; None for keys that are too short."""
    keys: list[bytes | None] = []
    for line in text.encode().lower().split(b"\n"):  # bytes: ASCII case only
        key = line.strip(_WHITE)
        long_enough = len(key) >= shortest and (len(key) >= 4 * shortest or len(key.decode()) >= shortest)
        keys.append(xxhash.xxh3_128_digest(key) if long_enough else None)
    return keys


class PerfectHash:
    """A minimal perfect hash over distinct 128-bit keys given as two arrays of unsigned 64-bit halves."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks = [np.cumsum(bits, dtype="int64") - 1 for bits in levels]
        self.bases = np.cumsum([0, *(int(r[-1]) + 1 for r in self.ranks)])

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        levels = []
        while len(high):
            places = _places(high, low, len(levels), 2 * len(high))
            taken = np.bincount(places, minlength=2 * len(high))
            levels.append(taken == 1)
            left = taken[places] != 1
            high, low = high[left], low[left]
        return cls(levels)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each key, in 0 .. n - 1; of a key that is not in the set any slot, or -1."""
        out = np.full(len(high), -1, "int64")
        open_rows = np.arange(len(high))
        for k, bits in enumerate(self.levels):
            places = _places(high[open_rows], low[open_rows], k, len(bits))
            found = bits[places]
            out[open_rows[found]] = self.bases[k] + self.ranks[k][places[found]]
            open_rows = open_rows[~found]
        return out

    def pack(self) -> tuple[list[int], bytes]:
        return [len(bits) for bits in self.levels], b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def unpack(cls, sizes: list[int], packed: bytes) -> PerfectHash:
        levels, raw, at = [], np.frombuffer(packed, "uint8"), 0
        for size in sizes:
            length = -(-size // 8)
            levels.append(np.unpackbits(raw[at : at + length], count=size).astype(bool))
            at += length
        return cls(levels)


def _places(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = high + (low | np.uint64(1)) * np.uint64(_GOLDEN * (2 * level + 1) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype("int64")


def keys_of(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """``(doc, content, high, low)``: each key of each ``(doc, content, text)`` row once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({k for k in line_keys(t or "", shortest) if k}) for t in batch.column("text").to_pylist()]
            halves = np.frombuffer(b"".join(k for keys in found for k in keys), ">u8").astype("uint64").view("int64")
            rows = pa.array(np.repeat(np.arange(len(found)), [len(keys) for keys in found]))
            columns = [batch.column("doc").take(rows), batch.column("content").take(rows)]
            columns += [pa.array(halves[0::2]), pa.array(halves[1::2])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "content", "high", "low"])

    return docs.select("doc", "content", "text").mapInArrow(run, "doc long, content long, high long, low long")


def build_index(repeated: DataFrame) -> DataFrame:
    """One row a shard from ``(shard, high, low, documents, first)``: the hash's levels and its arrays."""

    def run(table: pa.Table) -> pa.Table:
        high, low = (_unsigned(table, name) for name in ("high", "low"))
        perfect = PerfectHash.build(high, low)
        order = np.argsort(perfect.slots(high, low))
        sizes, levels = perfect.pack()
        columns = {
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
            "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "levels": pa.array([levels], pa.binary()),
            "fingerprints": pa.array([low[order].tobytes()], pa.binary()),
            "counts": pa.array([_saturated(table, order).tobytes()], pa.binary()),
            "firsts": pa.array([table.column("first").to_numpy()[order].astype("int64").tobytes()], pa.binary()),
        }
        return pa.table(columns)

    schema = "shard int, sizes array<long>, levels binary, fingerprints binary, counts binary, firsts binary"
    return repeated.groupBy("shard").applyInArrow(run, schema)


def probe(probes: DataFrame, index: DataFrame) -> DataFrame:
    """The ``(doc, content, high, low)`` rows whose key an earlier document holds."""

    def run(keys: pa.Table, shard: pa.Table) -> pa.Table:
        out = keys.select(["doc", "content", "high", "low"])
        if not shard.num_rows or not keys.num_rows:
            return out.slice(0, 0)
        row = shard.to_pylist()[0]
        perfect = PerfectHash.unpack(row["sizes"], row["levels"])
        fingerprints = np.frombuffer(row["fingerprints"], "uint64")
        counts = np.frombuffer(row["counts"], "uint32")
        firsts = np.frombuffer(row["firsts"], "int64")
        high, low = (_unsigned(keys, name) for name in ("high", "low"))
        slots = perfect.slots(high, low)
        lost = (slots >= 0) & (fingerprints[slots] == low)
        lost &= (counts[slots] >= 2) & (firsts[slots] != keys.column("doc").to_numpy())
        return out.filter(pa.array(lost))

    grouped = probes.groupBy("shard").cogroup(index.groupBy("shard"))
    return grouped.applyInArrow(run, "doc long, content long, high long, low long")


def lost_keys(keys: DataFrame, shards: int | None = None) -> DataFrame:
    """Of ``keys_of`` rows, those whose lines go: an earlier document holds the key."""
    counted = keys.groupBy("high", "low").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("documents")
    )
    repeated = staged(counted.where(F.col("first") != F.col("last")).drop("last"), "repeated-lines")
    rows = keys.count()
    shards = shards or max(partitions(keys.sparkSession), -(-rows // SHARD_KEYS))
    hot = max(256, rows // (4 * shards))
    shard = F.pmod(F.col("high"), F.lit(shards)).cast("int").alias("shard")
    index = staged(build_index(repeated.where(F.col("documents") < hot).select("*", shard)), "line-index")
    # At most rows / hot <= 4 * shards keys. Written, so that Spark knows their bytes: it broadcasts them up to its limit for
    # that, and beyond it joins by key, where a skew join splits a key of very many rows.
    frequent = staged(repeated.where(F.col("documents") >= hot).select("high", "low", "first"), "frequent-lines")
    marked = keys.join(frequent, ["high", "low"], "left")
    cold = marked.where("first IS NULL").select("doc", "content", "high", "low", shard)
    lost = marked.where("first != doc").select("doc", "content", "high", "low")
    return probe(cold, index).union(lost)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``__row`` (the other columns as a struct), ``kept``, ``n_lines`` (before dropping) and ``n_dropped``."""
    full = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = packed(docs, doc_id, text, but=(text,)).select(
        "__row",
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(full).alias("content"),
        full.alias("text"),
    )
    keys = staged(keys_of(rows, shortest), "line-keys")
    lost = lost_keys(keys).groupBy("doc", "content").agg(F.collect_set(F.struct("high", "low")).alias("lost"))
    lost = staged(lost, "lost-lines")
    own = F.xxhash64("doc", "content")
    # At most a row a word of the filter.
    words = F.broadcast(bloom_filter(lost.select(own.alias("own")), "own", FILTER_WORDS))
    probed = rows.withColumn("__slot", bloom_slot(own, FILTER_WORDS)).join(words, "__slot", "left")
    may_lose = F.coalesce(F.col("__word").bitwiseAND(bloom_mask(own)) == bloom_mask(own), F.lit(False))
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    whole = probed.where(~may_lose).select(
        "__row", F.col("text").alias("kept"), n_lines.cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")
    )
    joined = probed.where(may_lose).join(lost, ["doc", "content"], "left").select("__row", "text", "lost")
    counts = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    schema = T.StructType([joined.schema["__row"], T.StructField("kept", T.StringType()), *counts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, before, dropped = [], [], []
            for value, gone in zip(batch.column("text"), batch.column("lost"), strict=True):
                value = value.as_py()
                lines = value.count("\n") + 1
                left = lines
                if gone.is_valid:
                    halves = np.array([(x["high"], x["low"]) for x in gone.as_py()], "int64").astype(">i8").tobytes()
                    drop = {halves[k : k + 16] for k in range(0, len(halves), 16)}
                    keys = line_keys(value, shortest)
                    stay = [line for line, key in zip(value.split("\n"), keys, strict=True) if key not in drop]
                    value, left = "\n".join(stay), len(stay)
                kept.append(value)
                before.append(lines)
                dropped.append(lines - left)
            columns = [batch.column("__row"), pa.array(kept, pa.string())]
            columns += [pa.array(before, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return whole.union(joined.mapInArrow(run, schema))


def _unsigned(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype("int64").view("uint64")


def _saturated(table: pa.Table, order: np.ndarray) -> np.ndarray:
    return np.minimum(table.column("documents").to_numpy()[order], 0xFFFFFFFF).astype("uint32")

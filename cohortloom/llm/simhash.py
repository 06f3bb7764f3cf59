"""SimHash near-duplicates with pivot distance tables.

1. **Fingerprints.** Words of a text lower-cased in A-Z, joined by single spaces; each run of ``shingle`` words is hashed
   with XXH64, and a bit is set where it is set in over half the hashes.
2. **Candidates.** Copies share a fingerprint, so only distinct fingerprints go on. Two of them within ``max_bits`` agree
   wholly on some of any ``max_bits + 1`` or more blocks of bits; every choice of that many blocks deals fingerprints
   into buckets. There are more blocks, and so finer buckets, the more fingerprints there are. Buckets beyond ``chunk``
   rows are cut into parts, and each pair of parts becomes a bucket of its own, so no task holds more than two parts.
3. **Pivots.** In a bucket, the Hamming distances of each fingerprint to many fixed reference fingerprints are tabled. By
   the triangle inequality, two fingerprints within ``max_bits`` differ by at most that in each coordinate. Sorting by the
   first coordinate leaves a window of partners; the other coordinates discard pairs by their largest difference, and what
   survives is verified by counting differing bits.
4. **Groups.** A bucket reports a spanning forest of its links, not all pairs; components are found on these.

A pivot table alone would have to look at every pair of the corpus; the blocks choose which pairs it sees, and lose none.

Defined cases: a null or blank text has fingerprint zero and is linked like any other; a row without id gets its
fingerprint, takes no part in groups and has component null; rows that share an id are one document, which is in the
groups of all its texts; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.components import components
from cohortloom.llm.frames import inputs, packed, partitions, staged, unpacked

SEED = 42
BITS = 64
PIVOTS = 32
#: Rows of a bucket that one task compares at once, and the mean size of a bucket at which blocks get finer.
CHUNK = 2048
MEAN_BUCKET = 2000
_HASHES_AT_ONCE = 200_000
_PAIRS_AT_ONCE = 1 << 20


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``(doc_id, fingerprint)``, the fingerprint a long of 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = fingerprints_of(batch.column("text").to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], names=["doc_id", "fingerprint"])

    given = inputs(docs, doc_id, text).toDF("doc_id", "text")
    rows = given.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, fingerprint long")


def fingerprints_of(texts: list[str | None], shingle: int) -> np.ndarray:
    out = np.zeros(len(texts), "uint64")
    hashes: list[int] = []
    rows: list[int] = []
    starts: list[int] = []

    def flush() -> None:
        if rows:
            bits = np.unpackbits(np.array(hashes, ">u8").view("uint8")).reshape(-1, BITS)
            counts = np.add.reduceat(bits, starts, axis=0, dtype="int32")
            total = np.diff([*starts, len(hashes)])
            out[rows] = np.packbits(2 * counts > total[:, None], axis=1).view(">u8").ravel()
        hashes.clear(), rows.clear(), starts.clear()

    digest = xxhash.xxh64_intdigest
    for row, text in enumerate(texts):
        words = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space only
        if not words:
            continue
        rows.append(row)
        starts.append(len(hashes))
        if len(words) <= shingle:
            hashes.append(digest(b" ".join(words), SEED))
        else:
            joined = b" ".join(words)
            ends = list(itertools.accumulate(len(w) + 1 for w in words))
            hashes.extend(
                [digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[shingle - 1 :], strict=False)]
            )
        if len(hashes) >= _HASHES_AT_ONCE:
            flush()
    flush()
    return out.view("int64")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4, chunk: int = CHUNK
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row; the component is the smallest id reachable by links."""
    prints = staged(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    distinct = staged(
        prints.where("doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-prints"
    )
    roots = components(links(distinct.select("fingerprint"), max_bits, chunk))
    # An id with several texts ties their fingerprints together.
    linked = distinct.join(roots, distinct["fingerprint"] == roots["node"])
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = linked.select("fingerprint", "root").join(lowest, "root").select("fingerprint", "component_id")
    named_prints = distinct.join(of_print, "fingerprint", "left").select(
        F.col("fingerprint").alias("__print"), F.coalesce("component_id", "first").alias("__component")
    )
    # A plain join of two tables, so that a fingerprint of very many copies can be split.
    named_prints = staged(named_prints, "named-prints")
    return prints.join(named_prints, prints["fingerprint"] == named_prints["__print"], "left").select(
        "doc_id", "fingerprint", F.when(F.col("doc_id").isNotNull(), F.col("__component")).alias("component_id")
    )


def one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents whose id is the smallest of their group, and rows without id; all columns as given."""
    found = near_duplicates(docs, shingle=shingle, max_bits=max_bits)
    gone = staged(found.where("doc_id != component_id").select(F.col("doc_id").alias("__gone")).distinct(), "copies")
    rows = packed(docs, "doc_id")
    return rows.join(gone, rows["doc_id"] == gone["__gone"], "left_anti").select(*unpacked(docs.columns))


def block_masks(rows: int, max_bits: int) -> list[int]:
    """Bit masks of which two fingerprints within ``max_bits`` agree on at least one."""
    blocks = max_bits + 1
    while blocks < BITS and rows / 2 ** ((blocks - max_bits) * (BITS // blocks)) > MEAN_BUCKET:
        blocks += 1
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    return [sum(chosen) for chosen in itertools.combinations(parts, blocks - max_bits)]


def links(distinct: DataFrame, max_bits: int = 4, chunk: int = CHUNK) -> DataFrame:
    """Edges ``(a, b)`` that connect distinct fingerprints exactly as all pairs within ``max_bits`` would."""
    spark = distinct.sparkSession
    masks = block_masks(distinct.count(), max_bits)
    value = F.col("fingerprint")
    dealt = distinct.select(
        value,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("block"), value.bitwiseAND(F.lit(_signed(mask))).alias("key"))
                    for k, mask in enumerate(masks)
                ]
            )
        ).alias("at"),
    ).select("fingerprint", "at.*")
    large = (
        dealt.groupBy("block", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > chunk)
        .select("block", "key", F.ceil(F.col("rows") / chunk).cast("int").alias("parts"))
    )
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64("fingerprint"), parts).cast("int")
    tiled = dealt.join(large, ["block", "key"], "left").select(
        "block", "key", part.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"), "fingerprint"
    )
    buckets = tiled.select(
        "block",
        "key",
        F.least("part", "other").alias("low"),
        F.greatest("part", "other").alias("high"),
        "part",
        "fingerprint",
    )
    keys = ["block", "key", "low", "high"]
    sorted_buckets = buckets.repartition(partitions(spark), *keys).sortWithinPartitions(*keys)
    return sorted_buckets.mapInArrow(_forest_of_buckets(max_bits), "a long, b long")


def pivot_table(prints: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Hamming distances of each fingerprint to fixed reference fingerprints."""
    references = np.array([xxhash.xxh64_intdigest(b"pivot %d" % k, SEED) for k in range(pivots)], "uint64")
    return np.bitwise_count(prints[:, None] ^ references[None, :]).astype("int16")


def close_pairs(
    bucket: np.ndarray, prints: np.ndarray, max_bits: int, apart: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs in the same bucket within ``max_bits``, in blocks. ``apart``: only pairs of unlike values."""
    table = pivot_table(prints)
    span = 2 * BITS
    order = np.lexsort((table[:, 0], bucket))
    at = bucket[order] * span + table[order, 0]
    more = np.searchsorted(at, at + max_bits, "right") - np.arange(len(at)) - 1
    ends = np.cumsum(more)
    begin = 0
    while begin < len(at):
        done = ends[begin - 1] if begin else 0
        end = max(int(np.searchsorted(ends, done + _PAIRS_AT_ONCE, "right")), begin + 1)
        counts = more[begin:end]
        if counts.any():
            left = np.repeat(np.arange(begin, end), counts)
            right = left + 1 + np.arange(len(left)) - np.repeat(ends[begin:end] - counts - done, counts)
            left, right = order[left], order[right]
            if apart is not None:
                wanted = apart[left] != apart[right]
                left, right = left[wanted], right[wanted]
            for k in range(1, table.shape[1]):
                near = np.abs(table[left, k] - table[right, k]) <= max_bits
                left, right = left[near], right[near]
            near = np.bitwise_count(prints[left] ^ prints[right]) <= max_bits
            yield left[near], right[near]
        begin = end


def forest(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each position the smallest one that the pairs connect it to."""
    label = np.arange(size)
    for left, right in pairs:
        while True:
            low = np.minimum(label[left], label[right])
            after = label.copy()
            np.minimum.at(after, label[left], low)
            np.minimum.at(after, label[right], low)
            after = after[after]
            if np.array_equal(after, label):
                break
            label = after
    while not np.array_equal(label, label[label]):
        label = label[label]
    return label


def _forest_of_buckets(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: np.ndarray | None = None  # rows of a bucket that may go on in the next batch
        for rows in itertools.chain(map(_matrix, batches), [None]):
            if rows is None and kept is None:
                return
            table = kept if rows is None else rows if kept is None else np.concatenate([kept, rows])
            new = np.any(table[1:, :4] != table[:-1, :4], axis=1)
            last = 0 if rows is not None else len(table)
            if rows is not None and new.any():
                last = int(np.flatnonzero(new)[-1]) + 1
            kept = table[last:] if rows is not None else None
            if last == 0:
                continue
            table = table[:last]
            bucket = np.concatenate([[0], np.cumsum(new[: last - 1])])
            prints = table[:, 5].copy().view("uint64")
            for cross in (False, True):
                own = np.flatnonzero((table[:, 2] != table[:, 3]) == cross)
                if len(own):
                    apart = table[own, 4] if cross else None
                    label = forest(len(own), close_pairs(bucket[own], prints[own], max_bits, apart))
                    moved = np.flatnonzero(label != np.arange(len(own)))
                    ends = [pa.array(table[own[x], 5]) for x in (moved, label[moved])]
                    yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    return run


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(k).to_numpy().astype("int64") for k in range(batch.num_columns)])


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


"""Marking every row whose id occurs more than once in the batch, also when one id fills a third of it.

A window over the id would bring all copies of an id, whole rows, into one task. Instead:

1. Count ids with a partial aggregate: a task sends each of its ids once, whatever the number of copies, and no other
   column is shuffled. Ids seen twice or more are written to scratch; usually there are few.
2. If they fit a broadcast (their bytes are summed first), join them back without shuffling the rows at all.
3. If not, broadcast those with the most copies, as many as fit, and a Bloom filter of the others, of fixed size. Rows of the
   hot ids, rows without an id and rows that the filter misses are settled and stay where they are; only what may be a
   duplicate is shuffled, by id, to meet the other repeated ids.

The filter is a table of 64-bit words: an id picks one by its hash and sets four of its bits. It never misses a repeated id.
With ``w`` words and ``r`` repeated ids it takes about ``(1 - exp(-4 r / 64 w))^4`` of the other ids for repeated too, 2% at
8 ids a word; those rows are shuffled for nothing and come out as what they are. The marked input runs twice in this case.

In the third case an id can only bring many rows into one task if the ids with at least as many copies do not fit a
broadcast together; Spark's skew join splits such a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.sources.scratch import staged

BROADCAST_BYTES = 64 << 20
#: Words of the Bloom filter; a broadcast one takes about 50 bytes a word.
FILTER_WORDS = 1 << 20
_BITS = 4
_ROW_OVERHEAD = 64  # hash-table cost of one broadcast row, beside its id


def repeated_ids(frame: DataFrame, key: str = "sample_id") -> DataFrame:
    """``(id, copies)`` for the ids that occur more than once. NULL is not an id."""
    counted = frame.select(F.col(key).alias("id")).where(F.col("id").isNotNull())
    return counted.groupBy("id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def mark_duplicates(
    frame: DataFrame,
    key: str = "sample_id",
    flag: str = "is_duplicate",
    broadcast_bytes: int = BROADCAST_BYTES,
    filter_words: int = FILTER_WORDS,
) -> DataFrame:
    """Add a boolean column that is true on every copy of a repeated id. Runs the id count when called."""
    repeated = staged(repeated_ids(frame, key), "repeated-ids")
    octaves = F.floor(F.log2("copies")).cast("int").alias("octave")
    cost = F.sum(F.octet_length(F.col("id").cast("string")) + _ROW_OVERHEAD).alias("bytes")
    sizes = {row.octave: row.bytes for row in repeated.groupBy(octaves).agg(cost).collect()}  # at most 63 rows
    hot_from, total = 64, 0
    for octave in sorted(sizes, reverse=True):
        total += sizes[octave]
        if total > broadcast_bytes:
            break
        hot_from = octave
    if total <= broadcast_bytes:
        return _looked_up(frame, repeated, key).select(*_columns(frame), _decided("__found").alias(flag))
    return _mark_split(frame, repeated, key, flag, 2.0**hot_from, filter_words)


def _mark_split(
    frame: DataFrame, repeated: DataFrame, key: str, flag: str, hot_copies: float, filter_words: int
) -> DataFrame:
    is_hot = F.col("copies") >= hot_copies
    cold = repeated.where(~is_hot)
    # As many rows as the filter has words, at most.
    words = F.broadcast(bloom_filter(cold, "id", filter_words))
    marked = _looked_up(frame, repeated.where(is_hot), key).withColumn("__slot", bloom_slot(F.col(key), filter_words))
    marked = marked.join(words, "__slot", "left")
    mask = bloom_mask(F.col(key))
    may_be_cold = F.col("__found").isNull() & F.coalesce(F.col("__word").bitwiseAND(mask) == mask, F.lit(False))
    settled = marked.where(~may_be_cold).select(*_columns(frame), _decided("__found").alias(flag))
    ids = cold.select(F.col("id").alias("__id"), F.lit(True).alias("__found"))
    rest = marked.where(may_be_cold).select(*_columns(frame))
    joined = rest.join(ids, rest[key] == ids["__id"], "left")
    return settled.union(joined.select(*_columns(frame), _decided("__found").alias(flag)))


def bloom_filter(ids: DataFrame, key: str, words: int) -> DataFrame:
    """``(__slot, __word)``: the words of a filter in which some bit is set; a NULL id sets none."""
    slots = ids.where(F.col(key).isNotNull()).select(bloom_slot(F.col(key), words).alias("__slot"), bloom_mask(F.col(key)).alias("bits"))
    return slots.groupBy("__slot").agg(F.bit_or("bits").alias("__word"))


def bloom_slot(value: Column, words: int) -> Column:
    """The word an id belongs to; NULL without id, as the hash of NULL is one word like any other."""
    return F.when(value.isNotNull(), F.pmod(F.xxhash64(F.lit("slot"), value), F.lit(words)))


def bloom_mask(value: Column) -> Column:
    """The bits of an id within its word: four times six bits of a second hash."""
    h = F.xxhash64(F.lit("bits"), value)
    places = [F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(_BITS)]
    one = F.lit(1).cast("long")
    return reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", one, place) for place in places])


def _looked_up(frame: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows with ``__found``, true for these ids; the ids' bytes have been summed and fit a broadcast."""
    found = F.broadcast(ids.select(F.col("id").alias("__id"), F.lit(True).alias("__found")))
    return frame.join(found, frame[key] == found["__id"], "left")


def _columns(frame: DataFrame) -> list[Column]:
    return [F.col(f"`{name}`") for name in frame.columns]


def _decided(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))

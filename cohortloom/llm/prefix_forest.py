"""Approximate nearest neighbours with a forest of hash prefixes.

Each tree gives a vector a long string of bits, the signs of its products with the tree's own random directions, and
keeps the strings in sorted order, so all strings that share a prefix with a query lie in one run. A search descends every
tree to the longest prefix that the query shares with any string, which one of its two neighbours in sorted order has, then
ascends in all trees at once, a bit at a time, from the deepest of these matches until the runs together hold enough
candidates; a tree joins in at the depth of its own match, and runs are taken whole. Candidates are scored exactly, in
double precision, on the original vectors.

The corpus is cut into blocks of ``block_rows`` vectors by a hash of the id and the stated queries into blocks of
``query_rows``; each pair of blocks is a group with a forest of its own, and only the nearest of each group meet again. So
a task's memory is bounded, and no vector is shuffled per candidate. Every row is indexed, and every query searches every
block. Equal vectors of a block are indexed once with the smallest ids that hold them, so neither many copies nor the room
that they take in runs can push others out; hot vectors are spread over the blocks by their ids.

Inner products are searched as angles: vectors get one more component that makes all of a block equally long.

Defined cases: vectors that are null, empty, of another length than the most frequent one of the corpus (of two as frequent,
the shorter), zero, or hold null or non-finite components take no part, neither do rows without id; rows that share an id
are searched and found once each; ties go to the smaller id; a query finds all candidates if there are fewer than ``k``; an
empty table gives an empty table; names may differ from others in case only; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.frames import cut, inputs

SCHEMA = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Settings:
    """``candidates``: rows in the runs of all trees, as a share of the block's distinct vectors, at which ascent ends.

    Ascent goes on below ``least`` rows, the same vector counting once for each tree.
    """

    k: int = 20
    trees: int = 128
    bits: int = 24
    candidates: float = 0.5
    least: int = 4096
    block_rows: int = 8192
    query_rows: int = 16384
    seed: int = 7


def usable(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(vec_id, embedding)`` of the rows that take part, components as doubles."""
    given = inputs(rows, vec_id, embedding).toDF("vec_id", "embedding")
    vector = F.transform("embedding", lambda x: x.cast("double"))
    chosen = given.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding"))

    def is_finite(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))

    return chosen.where(
        F.col("vec_id").isNotNull()
        & F.coalesce(F.forall("embedding", is_finite) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    )


def search(
    corpus: DataFrame, queries: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest found of each of ``queries``; both frames come from ``usable``."""
    corpus, queries = cut(corpus), cut(queries)
    length = F.size("embedding")
    most = corpus.groupBy(length.alias("length")).count().orderBy(F.desc("count"), "length").first()
    width = most["length"] if most else 0
    corpus, queries = corpus.where(length == width), queries.where(length == width)
    blocks = max(1, -(-corpus.count() // settings.block_rows))
    query_blocks = max(1, -(-queries.count() // settings.query_rows))

    def dealt(rows: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        number = F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
        return rows.select(
            "vec_id", "embedding", number.alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other)
        )

    stored = dealt(corpus, "block", blocks, "query_block", query_blocks).groupBy("block", "query_block")
    asked = dealt(queries, "query_block", query_blocks, "block", blocks).groupBy("block", "query_block")

    def run(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        found = list(_searched(rows, wanted, settings))
        names = ["query_id", "vec_id", "score"]
        empty = [np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)]
        return pa.table(dict(zip(names, map(np.concatenate, zip(*found, strict=True)) if found else empty, strict=True)))

    found = stored.cogroup(asked).applyInArrow(run, SCHEMA)
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= settings.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


class Forest:
    """Sorted arrays of hash strings over distinct vectors, one array a tree."""

    def __init__(self, vectors: np.ndarray, settings: Settings) -> None:
        self.settings = settings
        length = np.linalg.norm(vectors, axis=1)
        longest = float(length.max())
        lift = np.sqrt(np.maximum(longest**2 - length**2, 0.0))
        random = np.random.default_rng(settings.seed)
        shape = (vectors.shape[1] + 1, settings.trees * settings.bits)
        self.directions = random.standard_normal(shape).astype("float32")
        hashes = self._hashes(np.column_stack([vectors, lift]) / longest)
        self.order = np.argsort(hashes, axis=0, kind="stable").astype("int32")
        self.strings = np.take_along_axis(hashes, self.order, axis=0)

    def _hashes(self, vectors: np.ndarray) -> np.ndarray:
        trees, bits = self.settings.trees, self.settings.bits
        out = np.empty((len(vectors), trees), "uint32")
        weights = (1 << np.arange(bits - 1, -1, -1)).astype("uint32")
        for begin in range(0, len(vectors), 1024):
            signs = vectors[begin : begin + 1024].astype("float32") @ self.directions > 0
            out[begin : begin + 1024] = signs.reshape(-1, trees, bits) @ weights
        return out

    def runs(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and tree the run of strings to take: begin and end in the tree's order."""
        scale = np.maximum(np.linalg.norm(queries, axis=1), 1e-300)[:, None]
        hashes = self._hashes(np.column_stack([queries / scale, np.zeros(len(queries))]))
        size, bits = len(self.order), self.settings.bits
        enough = max(self.settings.least, round(self.settings.candidates * size))
        matched = self.longest(hashes)
        deepest = matched.max(axis=1)
        begin, end = np.zeros(hashes.shape, "int64"), np.zeros(hashes.shape, "int64")
        climbing = np.ones(len(queries), bool)
        for depth in range(int(deepest.max(initial=0)), -1, -1):  # in all trees at once
            shift = bits - depth
            joined = climbing[:, None] & (matched >= depth)
            for tree in np.flatnonzero(joined.any(axis=0)):
                own = np.flatnonzero(joined[:, tree])
                low = hashes[own, tree] >> shift << shift
                begin[own, tree] = np.searchsorted(self.strings[:, tree], low, "left")
                end[own, tree] = np.searchsorted(self.strings[:, tree], low + ((1 << shift) - 1), "right")
            climbing &= (end - begin).sum(axis=1) < enough
            if not climbing.any():
                break
        return begin, end

    def longest(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash string and tree, the bits of the longest prefix that it shares with any string of the tree."""
        out = np.empty(hashes.shape, "int64")
        for tree in range(hashes.shape[1]):
            strings, own = self.strings[:, tree], hashes[:, tree]
            at = np.searchsorted(strings, own)
            near = [strings[np.clip(at + step, 0, len(strings) - 1)] ^ own for step in (-1, 0)]
            out[:, tree] = self.settings.bits - np.frexp(np.minimum(*near).astype("float64"))[1]
        return out

    def candidates(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        marked = np.zeros(len(self.order), bool)
        for tree, (a, b) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
            marked[self.order[a:b, tree]] = True
        return np.flatnonzero(marked)


def _searched(rows: pa.Table, wanted: pa.Table, settings: Settings) -> Iterator[tuple]:
    """Query ids, vector ids and scores, for each query up to ``k`` of this block, and those that tie with the last."""
    if not rows.num_rows or not wanted.num_rows:
        return
    ids, vectors = _vectors(rows)
    query_ids, queries = _vectors(wanted)
    by_id = np.argsort(ids, kind="stable")
    ids, vectors = ids[by_id], vectors[by_id]
    distinct, member = np.unique(vectors, axis=0, return_inverse=True)
    holders = np.argsort(member, kind="stable")  # ids ascend within each distinct vector
    first = np.searchsorted(member[holders], np.arange(len(distinct) + 1))
    forest = Forest(distinct, settings)
    for at in range(0, len(queries), 512):
        begin, end = forest.runs(queries[at : at + 512])
        for k, query in enumerate(queries[at : at + 512]):
            near = forest.candidates(begin[k], end[k])
            rough = distinct[near] @ query
            if len(near) > settings.k + 1:  # one more than k: the query itself may be among them
                bound = np.partition(rough, -settings.k - 1)[-settings.k - 1]
                near = near[rough >= bound - 1e-9 * max(1.0, abs(bound))]
            scores = (distinct[near] * query).sum(axis=1)  # each row summed in the same order, so copies tie exactly
            held = [holders[first[x] : min(first[x + 1], first[x] + settings.k + 1)] for x in near]
            found = ids[np.concatenate(held)]
            score = np.repeat(scores, [len(h) for h in held])
            other = found != query_ids[at + k]
            found, score = found[other], score[other]
            best = np.lexsort((found, -score))[: settings.k]
            yield np.full(len(best), query_ids[at + k]), found[best], score[best]


def _vectors(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, all of one length."""
    values = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return table.column("vec_id").to_numpy(), values.reshape(table.num_rows, -1)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of exact neighbours that were found, rank by score so that ties count."""
    total = exact.count()
    hits = exact.join(found, ["query_id", "vec_id"], "left_semi").count()
    return hits / total if total else 1.0

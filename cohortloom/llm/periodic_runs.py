"""Runs: stretches of words that repeat with some period, and documents without the repeats.

A run is a maximal stretch whose words ``q`` apart are identical, ``q`` its smallest period, at least ``times`` periods and
``least`` words long. They are found by the runs theorem: every run holds a Lyndon word of length ``q`` that is the longest
one starting at its place, under an order of the words or under the opposite order. So a document takes three steps:

1. The Lyndon arrays under both orders, directly from the first phase of Baier's suffix sorter: suffixes are grouped by
   their first word; from the highest group to the lowest, each suffix before a group's members that is the nearest lower one
   takes them over, which lengthens its own Lyndon prefix and moves it to a higher group.
2. Each longest Lyndon word is a root; its period is carried on to both sides by the longest common extensions (LCE) of its
   place and the place one period on. Names of blocks of 1, 2, 4, ... words give these for all roots of a text at once.
3. What is long enough is a run; each one is found from several roots and counted once.

Before that, places that cannot be in a run are left out: a run's windows of up to eight words recur one period on, so only
stretches of recurring windows are searched, each of them whole.

A document is worked on by itself, so nothing is shuffled and hot sources or groups of copies make no difference. Memory
grows with a document's words, about 200 bytes for each, and its longest recurring stretch, about 4 bytes for each word and
doubling.

Defined cases: a null or empty text has no words, no runs and an empty collapse. Rows with the same id are kept apart, equal
rows get equal results. An empty table gives an empty table. Other columns pass through, also where names differ only in
case; those named like a result are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.frames import mapped, pieces

#: Runs count from so many words and so many periods on.
LEAST, TIMES = 24, 3
#: Bytes of text that are turned into one batch of results.
SLICE = 4 << 20

_RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])
_MADE = {"runs": T.ArrayType(_RUN, False), "collapsed": T.StringType()}


def collapse_runs(docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """All columns but the text, which gives way to its ``runs`` and to ``collapsed``.

    ``runs`` are ``(start, length, period)`` in words, by start and then period. ``collapsed`` holds, joined by one space,
    the words that no run contains behind its first period.
    """
    if least < 2 or times < 2:
        raise ValueError("A run has two periods and two words at least")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.list_(pa.struct([pa.field(name, pa.int64(), False) for name in _RUN.names]))
        for part in pieces(batches, "text", SLICE):
            found, texts = [], []
            for given in part.column("text").to_pylist():
                words = given.encode().split()  # at ASCII white space
                at = runs(words, least, times)
                found.append([dict(zip(_RUN.names, run, strict=True)) for run in at])
                texts.append(b" ".join(kept(words, at)).decode())
            columns = [part.column("__row"), pa.array(found, run_type), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["__row", *_MADE])

    full = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    return mapped(docs, {"text": text}, [full], step, _MADE, used_up=(text,))


def kept(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words that no run holds behind its first period."""
    if not found:
        return words
    dropped = np.zeros(len(words), bool)
    for start, length, period in found:
        dropped[start + period : start + length] = True
    return [word for word, gone in zip(words, dropped.tolist(), strict=True) if not gone]


def runs(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start and then period."""
    if len(words) < least:
        return []
    names: dict = {}
    letters = np.fromiter((names.setdefault(word, len(names)) for word in words), "int64", len(words))
    found = []
    for begin, end in _recurring(letters, least, times):
        found += [(begin + start, length, period) for start, length, period in _searched(letters[begin:end], least, times)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def _recurring(letters: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """Stretches that hold every run whole: of places whose windows of ``width`` letters recur.

    A run of length L >= ``least`` and period q has a window recurring q on or q back at each of its places where one fits,
    as long as ``width`` <= L - 2q + 1 or so. With L >= 3q that holds up to a width of a third of ``least``.
    """
    n = len(letters)
    width = max(1, min(8, least // 3)) if times >= 3 else 1
    windows = letters[: n - width + 1].astype("uint64")
    with np.errstate(over="ignore"):
        for k in range(1, width):  # equal windows get equal numbers; rarely others too, which costs time only
            windows = windows * np.uint64(0x9E3779B97F4A7C15) + letters[k : n - width + 1 + k].astype("uint64")
            windows ^= windows >> np.uint64(31)
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    recurs = np.zeros(len(windows) + 2, bool)
    inner = recurs[1:-1]
    inner[order[1:][same]] = True
    inner[order[:-1][same]] = True
    edges = np.flatnonzero(recurs[1:] != recurs[:-1])
    begins, ends = edges[::2], edges[1::2] + width - 1
    long = ends - begins >= least
    return list(zip(begins[long].tolist(), ends[long].tolist(), strict=True))


def _searched(letters: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """The runs of a stretch, from the roots of both orders."""
    n = len(letters)
    ranks = np.unique(letters, return_inverse=True)[1]
    blocks = _named_blocks(ranks)
    found = np.zeros((0, 3), "int64")
    for order in (ranks, ranks.max() - ranks):
        period = np.array(lyndon_array(order.tolist()), "int64")
        at = np.flatnonzero(period * times <= n)
        period = period[at]
        behind = _common_extension(blocks, at, at + period, n)
        before = _common_extension_back(blocks, at, at + period)
        length = before + period + behind
        counts = length >= np.maximum(least, times * period)
        found = np.concatenate([found, np.stack([at - before, length, period], axis=1)[counts]])
    return [tuple(run) for run in np.unique(found, axis=0).tolist()]


def lyndon_array(ranks: list[int]) -> list[int]:
    """For each place, the length of the longest Lyndon word that starts there.

    Groups stand in ascending order in a linked list (``below`` leads down); each has the length of the Lyndon word that all
    its suffixes start with. A suffix that has passed the sweep is done and keeps its group.
    """
    n = len(ranks)
    size: list[int] = []
    below: list[int] = []
    members: list[list[int]] = []
    group = [0] * n
    first: dict[int, list[int]] = {}
    for place, rank in enumerate(ranks):
        first.setdefault(rank, []).append(place)
    for rank in sorted(first):
        below.append(len(size) - 1)
        size.append(1)
        members.append(first[rank])
    for number, places in enumerate(members):
        for place in places:
            group[place] = number
    above = {low: high for high, low in enumerate(below)}

    done = [False] * n
    lower = [-1] * n  # the nearest place before a done one whose group was lower than its own
    current = len(size) - 1
    while current >= 0:
        places = [place for place in members[current] if group[place] == current]
        members[current] = []
        for place in places:
            done[place] = True
        taken: Counter[int] = Counter()
        for place in places:
            at = place - 1
            while at >= 0 and done[at]:
                at = lower[at]
            lower[place] = at
            if at >= 0:
                taken[at] += 1
        moves: dict[tuple[int, int], list[int]] = {}
        for place in sorted(taken):
            moves.setdefault((group[place], taken[place]), []).append(place)
        # A suffix that takes over more copies of the word is higher; each group goes right above the old one.
        for old, copies in sorted(moves, reverse=True):
            new = len(size)
            size.append(size[old] + copies * size[current])
            members.append(moves[old, copies])
            for place in members[new]:
                group[place] = new
            high = above.get(old)
            below.append(old)
            above[old] = new
            if high is not None:
                below[high] = new
                above[new] = high
        current = below[current]
    return [size[number] for number in group]


def _named_blocks(ranks: np.ndarray) -> list[np.ndarray]:
    """Per power of two, a number for the block of so many letters at each place; equal blocks have equal numbers."""
    blocks = [ranks.astype("int32")]
    width = 1
    while 2 * width <= len(ranks):
        last = blocks[-1].astype("int64")
        pairs = last[: len(ranks) - 2 * width + 1] * (last.max() + 1) + last[width:]
        names, blocks_of = np.unique(pairs, return_inverse=True)
        if len(names) == len(pairs):
            break  # no longer block recurs
        blocks.append(blocks_of.astype("int32"))
        width *= 2
    return blocks


def _common_extension(blocks: list[np.ndarray], left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """How many letters from ``left`` on equal those from ``right`` on; ``left`` lies before ``right``."""
    length = np.zeros(len(left), "int64")
    for power, numbers in reversed(list(enumerate(blocks))):  # twice the longest block never recurs
        fits = np.flatnonzero(right + length + (1 << power) <= n)
        same = fits[numbers[left[fits] + length[fits]] == numbers[right[fits] + length[fits]]]
        length[same] += 1 << power
    return length


def _common_extension_back(blocks: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many letters before ``left`` equal those before ``right``."""
    length = np.zeros(len(left), "int64")
    for power, numbers in reversed(list(enumerate(blocks))):
        fits = np.flatnonzero(left - length >= 1 << power)
        begins = [ends[fits] - length[fits] - (1 << power) for ends in (left, right)]
        same = fits[numbers[begins[0]] == numbers[begins[1]]]
        length[same] += 1 << power
    return length

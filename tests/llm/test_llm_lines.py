"""Line dedup against a dictionary of lines."""

from __future__ import annotations

import collections

import llm_cases as cases
import numpy as np
import pytest

from cohortloom.llm import line_dedup

LAST = line_dedup.LAST_ID


def key(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def expected(rows: list[tuple]) -> list[tuple]:
    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(LAST if i is None else i)
    out = []
    for i, text in rows:
        own, lines = LAST if i is None else i, (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 2 or min(holders[key(x)]) == own]
        out.append((own, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def found(frame) -> list[tuple]:
    rows = line_dedup.dedup_lines(frame).select("__row.doc_id", "kept", "n_lines", "n_dropped").collect()
    return sorted((LAST if r[0] is None else r[0], *r[1:]) for r in rows)


def test_cases(spark):
    assert found(cases.with_clashes(spark)) == expected(cases.TEXTS)
    assert found(cases.empty(spark)) == []


def test_frequent_lines_and_many_shards(spark):
    rows = [(k, f"a line that all hold\nown line number {k}\nshared by some {k % 7}\nälter {k % 2}") for k in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    assert found(frame) == expected(rows)


@pytest.mark.parametrize("shards", [1, 5])
def test_both_ways_of_looking_up(spark, shards):
    rows = [(k, k, "common line of all\n" + f"line number {k % 300}") for k in range(900)]
    keys = line_dedup.keys_of(spark.createDataFrame(rows, "doc long, content long, text string"))
    lost = line_dedup.lost_keys(keys, shards)
    assert lost.count() == 899 + 600 and lost.distinct().count() == 1499


def test_perfect_hash():
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 2**63, (2, 20_000), dtype="uint64")
    perfect = line_dedup.PerfectHash.build(high, low)
    assert sorted(perfect.slots(high, low).tolist()) == list(range(20_000))
    again = line_dedup.PerfectHash.unpack(*perfect.pack())
    assert np.array_equal(again.slots(high, low), perfect.slots(high, low))
    others = again.slots(low, high)
    assert others.min() >= -1 and others.max() < 20_000
    assert len(line_dedup.PerfectHash.build(high[:0], low[:0]).slots(high, low)) == 20_000

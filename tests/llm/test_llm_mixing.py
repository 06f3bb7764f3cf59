"""The mix against targets found by repeated sharing."""

from __future__ import annotations

import collections
import re

import llm_cases as cases
import pytest

from cohortloom.llm import mixing

SF_DIR = "/root/testdata/sf0.01"


def shared(sizes: dict) -> dict:
    """Targets by handing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, open_names, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_names:
        level = total / sum(weight[s] for s in open_names)
        full = {s for s in open_names if level * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_names}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        total -= sum(2 * sizes[s] for s in full)
        open_names -= full
    return target


def taken(frame) -> list:
    rows = mixing.sized(frame)
    return mixing.with_copies(rows, mixing.plan(rows)).select(
        "__row.doc_id", "__row.source", "__row.text", "size", "source_size", "target", "copies"
    ).collect()


@pytest.fixture(scope="module")
def mixed_rows(spark):
    return taken(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_targets_and_sizes(mixed_rows):
    sizes = collections.Counter()
    for r in mixed_rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] += r.size
    want = shared(sizes)
    for r in mixed_rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])


def test_words_taken(mixed_rows):
    got, target = collections.Counter(), {}
    for r in mixed_rows:
        got[r.source] += r.copies * r.size
        target[r.source] = r.target
        assert 0 <= r.copies <= 2
    for source, words in got.items():
        assert words == pytest.approx(target[source], rel=0.05)  # sources of 50 documents


def test_reruns_agree(spark, mixed_rows):
    again = taken(spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(7))
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in mixed_rows)


def test_inclusion_follows_its_probability(spark):
    """Over many seeds, documents are taken about as often as their expected copies say."""
    words = [1, 2, 4, 8, 16, 32] * 8
    rows = [(k, "w " * n, "ab"[k % 2]) for k, n in enumerate(words)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").cache()
    times, expected, seeds = collections.Counter(), {}, 12
    for seed in range(seeds):
        sized = mixing.sized(frame, seed)
        plan = mixing.plan(sized, weights=(1.0,), share=0.5, seed=seed)
        rates = {(r.key, r["class"]): float(r.base) + r.chance for r in plan.rates.collect()}
        for r in mixing.with_copies(sized, plan).collect():
            times[r.size] += r.copies
            expected[r.size] = rates[r.key, r["class"]]
    for size, rate in expected.items():
        assert times[size] / (8 * seeds) == pytest.approx(rate, abs=0.17)


def test_cases(spark):
    frame = cases.with_clashes(spark)
    got = taken(frame)
    assert len(got) == len(cases.TEXTS) and all(r.copies * r.size <= 2 * r.size for r in got)
    mix = mixing.plan(mixing.sized(frame))
    out = mixing.mixed(frame, mix)
    assert out.columns == frame.columns and out.count() == sum(r.copies for r in got)
    assert taken(cases.empty(spark)) == []
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.target, r.copies * r.size) for r in taken(blank)] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize("parts", [1, 5])
def test_rows_alike_meet_the_target(spark, parts):
    """A hot group of rows alike in every column is taken in part, whatever tasks it came in."""
    rows = [(1, "w " * 20, "a")] * 300 + [(k, f"v{k} " * 20, "a") for k in range(2, 22)]
    rows += [(k, f"x{k} " * 50, "b") for k in range(100, 200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
    got = taken(frame)
    for source in "ab":
        own = [r for r in got if r.source == source]
        assert sum(r.copies * r.size for r in own) == pytest.approx(own[0].target, rel=0.01)
    assert len(got) == len(rows) and all(0 <= r.copies <= 2 for r in got)
    again = taken(frame.repartition(3))
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in got)
    out = mixing.mixed(frame, mixing.plan(mixing.sized(frame)))
    assert out.columns == frame.columns and out.count() == sum(r.copies for r in got)


def test_names_alike_but_for_case(spark):
    frame = cases.alike(spark.createDataFrame([(1, "a b c", "x"), (2, "d e", "y")], "doc_id long, text string, source string"))
    got = mixing.sized(frame).select("__row.doc_id", "key", "size").collect()
    assert sorted(map(tuple, got)) == [(1, "=x", 3), (2, "=y", 2)]
    out = mixing.mixed(frame, mixing.plan(mixing.sized(frame)))
    assert out.columns == frame.columns and {r[1] for r in out.collect()} <= {1, 2}

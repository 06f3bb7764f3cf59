"""The prefix forest against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from cohortloom.llm import prefix_forest as forest

SCHEMA = "vec_id long, embedding array<float>, score string"


def vectors(count: int, seed: int = 1) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((count, 64)) + 1.5 * rng.standard_normal((10, 64))[rng.integers(0, 10, count)]
    return (x * rng.uniform(0.5, 2.0, (count, 1)) / 8).astype("float32")


def exact(x: np.ndarray, query: int, k: int) -> list[tuple[int, float]]:
    scores = (x.astype("float64") * x[query].astype("float64")).sum(axis=1)
    order = np.lexsort((np.arange(len(x)), -scores))
    return [(int(i), float(scores[i])) for i in order if i != query][:k]


def searched(spark, rows, settings=forest.Settings()):
    usable = forest.usable(spark.createDataFrame(rows, SCHEMA))
    out = {}
    for r in forest.search(usable, usable.where("vec_id % 20 = 0"), settings).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(i, s) for _, i, s in sorted(found)] for q, found in out.items()}


@pytest.mark.parametrize("blocks", [(8192, 16384), (700, 20)])
def test_recall(spark, blocks):
    x = vectors(3000)
    settings = forest.Settings(block_rows=blocks[0], query_rows=blocks[1])
    got = searched(spark, [(k, v.tolist(), "x") for k, v in enumerate(x)], settings)
    assert set(got) == set(range(0, 3000, 20))
    hits = 0
    for query, found in got.items():
        want = exact(x, query, 20)
        hits += len({i for i, _ in want} & {i for i, _ in found})
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True) and len(found) == 20
        for i, score in found:
            assert score == pytest.approx(float(x[i].astype("float64") @ x[query].astype("float64")), abs=1e-12)
    assert hits / (20 * len(got)) >= 0.9


def test_many_copies_hide_nothing(spark):
    x = vectors(900)
    x[20] *= 4 / np.linalg.norm(x[20])
    x[300:700] = x[20]
    got = searched(spark, [(k, v.tolist(), "x") for k, v in enumerate(x)])
    assert [i for i, _ in got[20]] == [300 + k for k in range(20)]
    assert [i for i, _ in got[400]] == [20] + [300 + k for k in range(19)]
    hits = sum(len({i for i, _ in exact(x, q, 20)} & {i for i, _ in f}) for q, f in got.items())
    assert hits / (20 * len(got)) >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (1, [0.5, 0.5], "x"), (2, [0.5, 0.5], "x"), (20, [nan, 1.0], "x"), (40, None, "x")]
    rows += [(60, [0.0, 0.0], "x"), (3, [inf, 0.0], "x"), (4, [None, 1.0], "x"), (5, [], "x"), (None, [1.0, 1.0], "x")]
    rows += [(6, [1.0, 2.0, 3.0], "x")]
    assert searched(spark, rows) == {0: [(1, 0.5), (2, 0.5)]}
    assert searched(spark, []) == {} and searched(spark, [(0, [1.0], "x")]) == {}


def test_descent_and_ascent():
    """The longest matches equal those against every string; ascent adds no level beyond the first that is enough."""
    settings = forest.Settings(trees=6, bits=12, least=40, candidates=0.0)
    x = vectors(500).astype("float64")
    own = forest.Forest(x[:400], settings)
    lift = np.zeros((100, 1))
    hashes = own._hashes(np.hstack([x[400:] / np.linalg.norm(x[400:], axis=1)[:, None], lift]))
    longest = own.longest(hashes)
    begin, end = own.runs(x[400:])
    for k, tree in np.ndindex(longest.shape):
        shared = [12 - int(int(s) ^ int(hashes[k, tree])).bit_length() for s in own.strings[:, tree]]
        assert longest[k, tree] == max(shared)
    for k in range(100):
        per_depth = {
            d: sum(12 - int(int(s) ^ int(h)).bit_length() >= d for t, h in enumerate(hashes[k]) for s in own.strings[:, t])
            for d in range(13)
        }
        depth = max(d for d, n in per_depth.items() if n >= 40)
        assert (end[k] - begin[k]).sum() == per_depth[depth]


def test_one_length_takes_part(spark):
    """The corpus's most frequent length, whichever block its rows are in."""
    rows = [(k, [1.0 + k, 1.0], "x") for k in range(30)] + [(k, [1.0, 1.0, 1.0], "x") for k in range(30, 55)]
    few = searched(spark, rows, forest.Settings(block_rows=4, query_rows=2))
    assert few == searched(spark, rows) and set(few) == {0, 20} and all(i < 30 for i, _ in few[0] + few[20])

"""Runs against every period tried at every place; Lyndon arrays against the definition; the query against the contract."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import llm_cases as cases
import numpy as np
import pytest

from cohortloom.llm import catalogue, periodic_runs


def plainly(words: list, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """Every stretch in which words ``q`` apart are the same, unless a smaller period explains it."""
    names = {word: k for k, word in enumerate(dict.fromkeys(words))}
    w = np.array([names[word] for word in words])
    found = []
    for q in range(1, len(w) // times + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length = b - a + q
            if length < max(least, times * q):
                continue
            piece = w[a : a + length]
            if not any(q % p == 0 and np.array_equal(piece[:-p], piece[p:]) for p in range(1, q)):
                found.append((a, length, q))
    return sorted(found, key=lambda run: (run[0], run[2]))


def longest_lyndon(s: list[int]) -> list[int]:
    return [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]


def test_lyndon_arrays():
    rng = random.Random(1)
    for _ in range(1500):
        s = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(1, 30))]
        assert periodic_runs.lyndon_array(s) == longest_lyndon(s)
    fibonacci = [0]
    following = [0, 1]
    while len(following) < 500:
        fibonacci, following = following, following + fibonacci
    assert periodic_runs.lyndon_array(following) == longest_lyndon(following)


@pytest.mark.parametrize("least, times", [(24, 3), (2, 2), (6, 3), (10, 4), (25, 5)])
def test_runs_of_small_alphabets(least, times):
    rng = random.Random(least)
    for _ in range(400):
        words = []
        while len(words) < rng.randint(1, 120):
            unit = [rng.randrange(rng.randint(1, 6)) for _ in range(rng.randint(1, 9))]
            words += (unit * rng.randint(1, 7))[: rng.randint(1, 60)]
        assert periodic_runs.runs(words, least, times) == plainly(words, least, times), words


def test_runs_within_long_prose():
    rng = random.Random(5)
    for _ in range(12):
        words = []
        for _ in range(rng.randint(1, 4)):
            words += [min(int(rng.paretovariate(0.6)), 3000) for _ in range(rng.randint(0, 800))]
            unit = [min(int(rng.paretovariate(0.6)), 3000) for _ in range(rng.randint(1, 60))]
            words += (unit * rng.randint(2, 6))[: rng.randint(1, 250)]
        assert periodic_runs.runs(words) == plainly(words)


def test_long_texts_stay_fast():
    for words in ([0] * 300_000, [k % 1999 for k in range(300_000)]):
        assert len(periodic_runs.runs(words)) == 1


def expected(doc_id, text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plainly(words) if n >= 24 else []
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    left = " ".join(word for i, word in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, left)))


def test_query(spark, tmp_path):
    """Over part of the smallest table, for the time that trying every period takes, and every awkward text."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 10 == 0 or len(r.text) < 8000]
    rows += [(i, t) for i, t, *_ in cases.rows() if t not in (cases.LONG, cases.LONG + " end")]
    rows += [(900 + k, " ".join(["a b"] * k)) for k in range(8, 16)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalogue.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns[:3] == ["doc_id", "n_runs", "start"]
    want = [expected(*row) for row in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(w[1] for w in want) > 20


def test_awkward_tables(spark):
    frame = cases.with_clashes(spark).selectExpr("*", "'x' AS Text", "'y' AS runs")
    got = periodic_runs.collapse_runs(frame)
    assert [c for c in got.columns if c not in ("runs", "collapsed")] == [
        c for c in frame.columns if c not in ("text", "runs")
    ]
    rows = got.collect()
    assert len(rows) == len(cases.TEXTS)
    by_text = {r.collapsed: r for r in rows}
    assert by_text["one two three four five"].runs == [(0, 40, 5)]
    assert sum(r.collapsed == "" for r in rows) == 3  # null, empty, blank
    assert periodic_runs.collapse_runs(cases.empty(spark)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.collapse_runs(frame, times=1)

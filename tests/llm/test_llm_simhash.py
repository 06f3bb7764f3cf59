"""SimHash groups against all pairs."""

from __future__ import annotations

import itertools
import random

import llm_cases as cases
import numpy as np
import pytest
import xxhash

from cohortloom.llm import simhash
from cohortloom.llm.components import components


def fingerprint(text: str | None, size: int = 4) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: dict) -> dict:
    label = {x: x for x in prints}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            low, high = sorted((find(a), find(b)))
            label[high] = low
    return {x: find(x) for x in prints}


def near_prints(count: int) -> list[int]:
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = set()
    while len(out) < count:
        value = rng.choice(centres)
        for _ in range(rng.randrange(9)):
            value ^= 1 << rng.randrange(64)
        out.add(value)
    return sorted(out)


def test_fingerprints(spark):
    got = simhash.fingerprints(cases.with_clashes(spark)).collect()
    want = sorted((i or -1, fingerprint(t)) for i, t in cases.TEXTS)
    assert sorted((r.doc_id or -1, r.fingerprint % (1 << 64)) for r in got) == want


@pytest.mark.parametrize("chunk", [5, 2048])
def test_links_connect_what_all_pairs_connect(spark, chunk):
    prints = near_prints(400)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    edges = simhash.links(frame, 4, chunk)
    found = {r.a: set() for r in edges.collect()}
    pairs = {(r.a, r.b) for r in edges.collect()}
    assert found is not None and all(a != b for a, b in pairs)
    label = groups({p: q for p, q in zip(signed, prints, strict=True)})
    roots = {r.node: r.root for r in components(edges).collect()}
    together = lambda of: {frozenset(x for x in signed if of(x) == r) for r in map(of, signed)}
    assert together(lambda x: roots.get(x, x)) == together(label.__getitem__)


def test_pivots_never_discard_a_link():
    prints = np.array(near_prints(300), "uint64")
    got = {tuple(sorted(p)) for a, b in simhash.close_pairs(np.zeros(300, "int64"), prints, 4) for p in zip(a, b, strict=True)}
    want = {(a, b) for a, b in itertools.combinations(range(300), 2) if int(prints[a] ^ prints[b]).bit_count() <= 4}
    assert got == want


@pytest.mark.parametrize("rows", [0, 100, 10**7, 10**9])
def test_masks_catch_any_four_bits(rows):
    masks = simhash.block_masks(rows, 4)
    rng = random.Random(1)
    for _ in range(2000):
        off = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not mask & off for mask in masks)


def test_groups(spark):
    rows = [(i, t) for i, t in cases.TEXTS if i is not None and i != 12]
    want = groups({i: fingerprint(t) for i, t in rows})
    got = simhash.near_duplicates(cases.docs(spark)).collect()
    assert len(got) == len(cases.TEXTS)
    assert {r.doc_id: r.component_id for r in got if r.doc_id in want} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)
    kept = simhash.one_of_each(cases.docs(spark))
    assert kept.columns == cases.docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert {i for i in ids if i} == set(want.values()) | {12} and ids.count(None) == 2


def test_empty(spark):
    assert simhash.near_duplicates(cases.empty(spark)).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(k, k + 1) for k in range(100)] + [(200, 200), (301, 300), (300, 301), (None, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(101)} | {300: 300, 301: 300}

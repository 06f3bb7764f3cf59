"""The registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import ast
import base64
import hashlib
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from check_queries import compare, open_tables
from test_llm_lines import expected as deduplicated
from test_llm_mixing import shared
from test_llm_quality import counts
from test_llm_simhash import fingerprint, groups

import __spark_entry__ as entry
import corpus_pipeline
from cohortloom.llm import bpe, catalogue
from cohortloom.llm.catalogue import MULTILINGUAL
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", catalogue.ORACLE_SQL)
def test_query_matches_sql(spark, name):
    assert compare(spark, open_tables(SF_DIR), name, SF_DIR) is None


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def rows_of(spark, query) -> dict:
    rows = query(spark, SF_DIR).collect()
    found = {r[0]: r for r in rows}
    assert len(found) == len(rows)
    return found


def test_mix_query(spark, texts):
    got = rows_of(spark, catalogue.op1_pareto_mix)
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text)) for i, text in texts.items()}
    of_source, words = Counter(), Counter()
    for i, n in sizes.items():
        of_source[source[i]] += n
        words[source[i]] += got[i].taken
    target = shared(of_source)
    for i, row in got.items():
        assert (row["size"], row.source_size) == (sizes[i], of_source[source[i]])
        assert row.target == pytest.approx(target[source[i]])
        assert row.taken in (0, sizes[i], 2 * sizes[i])
    for name, total in words.items():
        assert total == pytest.approx(target[name], rel=0.05, abs=max(sizes.values()))
    assert rows_of(spark, catalogue.op1_pareto_mix) == got


def test_bpe_query(spark, texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows_of(spark, catalogue.op3_byte_bpe)
    assert set(got) == set(texts)
    for i, text in texts.items():
        ids = np.array(library.encode_ordinary(text), "<u4")
        digests = [hashlib.sha256(x).hexdigest() for x in (ids.tobytes(), text.encode())]
        assert tuple(got[i]) == (i, len(ids), *digests)


def test_forest_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], "float64")
    hits = total = 0
    found = {}
    for r in catalogue.op4_prefix_forest(spark, SF_DIR).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {i for i in ids.tolist() if i % 20 == 0}
    for query, near in found.items():
        scores = x @ x[ids == query][0]
        order = [k for k in np.lexsort((ids, -scores)) if ids[k] != query][:20]
        near.sort()
        assert [rank for rank, *_ in near] == list(range(1, len(order) + 1))
        assert np.allclose([s for *_, s in near], [scores[ids == i][0] for _, i, _ in near])
        hits += len({i for _, i, _ in near} & set(ids[order].tolist()))
        total += len(order)
    assert hits >= 0.9 * total


def test_token_file_query(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows_of(spark, catalogue.op5_token_files)
    start = 0
    for i in sorted(texts):
        ids = [*library.encode(texts[i], add_special_tokens=False).ids, 2]
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(texts)


def test_simhash_query(spark, texts):
    got = rows_of(spark, catalogue.op6_simhash)
    prints = {i: fingerprint(text) for i, text in texts.items()}
    roots = groups(prints)
    assert {i: tuple(r) for i, r in got.items()} == {i: (i, f"{prints[i]:016x}", roots[i]) for i in texts}


def test_classifier_queries(spark, texts):
    toxic = rows_of(spark, catalogue.op8_toxicity)
    assert set(toxic) == set(texts) == set(rows_of(spark, catalogue.op7_ordinal_quality))
    for i, row in toxic.items():
        assert row.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in catalogue.QUERIES}
    assert {*catalogue.QUERIES, "pipeline"} <= set(entry.queries())


def test_nothing_else_imports_the_subpackage():
    root = Path(corpus_pipeline.__file__).parent
    for path in (root / "cohortloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert not any("llm" in ast.unparse(n) for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, (ast.Import, ast.ImportFrom)))
    assert sys.modules["cohortloom.llm.catalogue"]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "line dedup",
        "SimHash near-dedup",
        "source mix",
        "byte-level BPE",
    ]
    run = dict(corpus_pipeline.STAGES)

    good = run["quality rules"](spark, docs, SF_DIR)
    before = {r.doc_id: r for r in docs.collect()}
    rows = {r.doc_id: r for r in good.collect()}
    assert good.columns == columns and all(rows[i] == before[i] for i in rows)
    for i, r in before.items():
        n_words, *_, repeated = counts(r.text)
        if n_words < 10 or 100 * repeated > 20 * n_words:
            assert i not in rows
    assert 0.5 < len(rows) / len(before) < 1

    fresh = run["line dedup"](spark, good, SF_DIR)
    want = {i: text for i, text, _, _ in deduplicated([(i, r.text) for i, r in rows.items()])}
    lines = {r.doc_id: r for r in fresh.collect()}
    assert fresh.columns == columns and {i: r.text for i, r in lines.items()} == want
    assert all(r.n_chars == len(r.text) for r in lines.values())

    alone = run["SimHash near-dedup"](spark, fresh, SF_DIR)
    firsts = set(groups({i: fingerprint(r.text) for i, r in lines.items()}).values())
    assert {r.doc_id: r for r in alone.collect()} == {i: lines[i] for i in firsts}

    mixed = run["source mix"](spark, alone, SF_DIR)
    taken = mixed.collect()
    assert mixed.columns == columns and all(r == lines[r.doc_id] for r in taken)
    ids = [r.doc_id for r in taken]
    assert max(map(ids.count, ids)) <= 2

    last = run["byte-level BPE"](spark, mixed, SF_DIR).collect()
    own = bpe.codec(MULTILINGUAL)
    assert sorted((r.doc_id, r.n_tokens) for r in last) == sorted((r.doc_id, len(own.encode(r.text)) // 4) for r in taken)

    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, last))

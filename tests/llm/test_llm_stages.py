"""The pipeline's stages over awkward documents, and what a run leaves behind."""

from __future__ import annotations

from pathlib import Path
from urllib.parse import urlparse

import corpus_pipeline
import llm_cases as cases
import pytest

from cohortloom.sources.scratch import ensure_checkpoint_dir

STAGES = dict(corpus_pipeline.STAGES)


def test_awkward_documents(spark):
    docs = cases.docs(spark)
    good = STAGES["quality rules"](spark, docs, "").collect()
    assert all(r.text and len(r.text.split()) >= 10 for r in good)

    lines = STAGES["line dedup"](spark, docs, "")
    kept = lines.collect()
    assert lines.columns == docs.columns and len(kept) == len(cases.TEXTS)
    assert all(r.n_chars == len(r.text) for r in kept)
    assert sorted(r.text for r in kept if r.doc_id in (4, 5)) == ["", ""]
    assert [len(r.text) for r in kept if r.doc_id == 12] == [len("one two three four five " * 8)] * 2
    short = STAGES["line dedup"](spark, docs.drop("n_chars"), "")
    assert short.columns == docs.drop("n_chars").columns and short.count() == len(kept)

    alone = [r.doc_id for r in STAGES["SimHash near-dedup"](spark, docs, "").collect()]
    assert alone.count(None) == 2 and alone.count(4) == 1 and not {5, 6, 14} & set(alone) and alone.count(12) == 2

    mixed = STAGES["source mix"](spark, docs, "")
    assert mixed.columns == docs.columns and max(map(mixed.collect().count, mixed.collect())) <= 4
    assert STAGES["byte-level BPE"](spark, docs, "").count() == len(cases.TEXTS)


@pytest.mark.parametrize("name", STAGES)
def test_empty_table(spark, name):
    docs = cases.empty(spark)
    out = STAGES[name](spark, docs, "")
    assert out.count() == 0
    if name != "byte-level BPE":
        assert out.columns == docs.columns


def test_scratch_holds_what_is_still_read(spark, tmp_path):
    cases.docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    folder = Path(urlparse(ensure_checkpoint_dir(spark)).path)
    before = set(folder.iterdir())
    out = corpus_pipeline.run(spark, str(tmp_path))
    left = {path.name for path in set(folder.iterdir()) - before}
    assert len(left) == 1 and next(iter(left)).startswith("corpus-source-mix-")
    assert {Path(urlparse(f).path).parent.name for f in out.inputFiles()} == left
    assert out.count() > 0

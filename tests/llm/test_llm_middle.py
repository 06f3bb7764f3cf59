"""Fill-in-middle against a plain version, and its way back."""

from __future__ import annotations

import hashlib
import re

import llm_cases as cases
import pyarrow as pa
from pyspark.sql import functions as F

from cohortloom.llm import fill_middle


def expected(doc_id, text: str | None) -> tuple:
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = [t for _, t in cases.TEXTS] + ["<", "<P", "P>x<S", "a<M>b", "<<PP>>", "\x00\x01 a", ">>M><", "é" * 5000, "a" * 70_000]


def test_every_form_and_back(spark):
    rows = [(k * 100 + i, t) for k in range(40) for i, t in enumerate(TEXTS) if k < 3 or len(t or "") < 5000] + [(None, "a b")]
    made = fill_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
    made = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back"]
    got = {r.doc_id: tuple(r)[1:] for r in made.collect()}
    for doc_id, text in rows:
        assert got[doc_id] == (*expected(doc_id, text), text or ""), (doc_id, text)
    assert {"plain", "psm", "spm"} == {row[1] for row in got.values()}


def test_seeds_and_rates(spark):
    frame = spark.range(2000).selectExpr("id AS doc_id", "'some words in a row' AS text")
    share = fill_middle.fill_in_middle(frame, seed="7", rearranged=50, suffix_first=100).groupBy("form").count().collect()
    assert {r["form"] for r in share} == {"plain", "spm"} and all(900 < r["count"] < 1100 for r in share)


def test_awkward_tables(spark):
    frame = cases.with_clashes(spark).selectExpr("*", "'x' AS Text", "'y' AS Output", "1 AS n")
    got = fill_middle.fill_in_middle(frame)
    others = [c for c in frame.columns if c not in ("text", "Output", "n")]
    assert got.columns == [*others, "n", "form", "prefix_chars", "middle_chars", "output"]
    rows = got.collect()
    want = sorted((expected(i, t) for i, t, *_ in cases.rows()), key=str)
    assert sorted((tuple(r)[-5:] for r in rows), key=str) == want
    assert {r["Text"] for r in rows} == {"x"}
    assert fill_middle.fill_in_middle(cases.empty(spark)).count() == 0


def test_separator_is_in_no_text():
    texts = pa.array(["\x01\x02", "".join(map(chr, range(1, 9)))], pa.large_string())
    assert fill_middle.units(texts).to_pylist() == [["\x01", "\x02", ""], [*map(chr, range(1, 9)), ""]]


def test_no_shuffle(spark):
    plan = fill_middle.fill_in_middle(cases.docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan

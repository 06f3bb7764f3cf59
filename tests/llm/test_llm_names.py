"""Operators over tables that hold columns whose names differ in case only."""

from __future__ import annotations

import llm_cases as cases
import public_tokenizers

from cohortloom.llm import bpe, chat, line_dedup, ordinal, prefix_forest, quality_rules, simhash, token_files, toxicity

ENGLISH = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def same(found, wanted):
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))


def test_rows_of_documents(spark):
    docs = cases.docs(spark)
    alike = cases.alike(docs)
    counts = ["__row.doc_id", "n_words", "n_symbols", "kept"]
    same(quality_rules.judged(alike).select(*counts), quality_rules.judged(docs).select(*counts))
    good = quality_rules.keep_good(alike)
    assert good.columns == alike.columns and good.count() == quality_rules.keep_good(docs).count()
    kept = ["__row.doc_id", "kept", "n_dropped"]
    same(line_dedup.dedup_lines(alike).select(*kept), line_dedup.dedup_lines(docs).select(*kept))
    one = simhash.one_of_each(alike)
    assert one.columns == alike.columns and one.count() == simhash.one_of_each(docs).count()
    ids = bpe.encode(alike, ENGLISH)
    assert ids.columns == [*(x for x in alike.columns if x != "text"), "ids"]
    assert sorted(r[-1] for r in ids.collect()) == sorted(r.ids for r in bpe.encode(docs, ENGLISH).collect())


def test_digests_of_documents(spark):
    docs = cases.docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    alike = cases.alike(docs)
    same(simhash.near_duplicates(alike), simhash.near_duplicates(docs))
    files = [token_files.read_documents(token_files.write_token_files(x, ENGLISH)) for x in (alike, docs)]
    same(*files)
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
    for operator in (ordinal, toxicity):
        same(
            operator.score(alike, operator.train(alike, cases.alike(labels))),
            operator.score(docs, operator.train(docs, labels)),
        )


def test_other_tables(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "ok")], "conv_id long, turn int, role string, text string")
    same(chat.format_chats(cases.alike(turns)), chat.format_chats(turns))
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 2.0])], "vec_id long, embedding array<double>")
    usable, alike = prefix_forest.usable(rows), prefix_forest.usable(cases.alike(rows))
    same(prefix_forest.search(alike, alike), prefix_forest.search(usable, usable))

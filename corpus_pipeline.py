"""A training corpus from raw documents: five stages, each written and read again by the next.

All stages take null or empty texts, texts of any length, null ids and sources, and rows that repeat, and give an empty
table for an empty one. Documents have the columns ``doc_id``, ``text`` and ``source``; others pass through. Since stages
are written as Parquet, names that differ only in case need ``spark.sql.caseSensitive``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import bpe, line_dedup, mixing, quality_rules, simhash
from cohortloom.llm.catalogue import MULTILINGUAL
from cohortloom.llm.frames import fields, staged
from cohortloom.sources.scratch import remove, settled


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: also null and empty texts, which have too few words. Rows repeat as given."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; ``n_chars``, if there is one, is the length of what stays.

    A null text becomes an empty one. Rows with one id are one document, so a repeated row keeps its lines; rows without id
    come after all others. A document that loses all its lines stays, with an empty text.
    """
    found = line_dedup.dedup_lines(docs)
    fresh = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    given = zip(docs.columns, fields(docs.columns), strict=True)
    return found.select(*[fresh.get(name, F.col("__row").getField(field)).alias(name) for name, field in given])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays, the one with the smallest id; rows without id stay.

    Null and empty texts are alike, so one of all of them stays. Rows that share the smallest id all stay.
    """
    return simhash.one_of_each(docs, shingle=4, max_bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight: documents are left out or repeated. Null sources are one source; documents without words stay or
    go by their rank. Of rows alike as many are taken as fit."""
    sizes = mixing.sized(docs).select("key", "size", "u", "class")
    return mixing.mixed(docs, mixing.plan(staged(sizes, "mix-sizes")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document's text, as digests that the decoded ids must give again. A null text is an empty one."""
    return bpe.round_trip(docs.select("doc_id", "text"), MULTILINGUAL)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_copies),
    ("source mix", mix),
    ("byte-level BPE", tokens),
]

#: Fingerprints, random ranks and merges are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Only the table that it reads stays in the scratch folder."""
    docs, earlier = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        done, path = settled(spark, f"corpus-{name.replace(' ', '-')}", lambda: stage(spark, docs, sf_dir))
        if earlier:
            remove(spark, earlier)
        docs, earlier = done, path
    return STAGES[-1][1](spark, docs, sf_dir)

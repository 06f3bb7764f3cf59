"""One query for each operator over its whole table, with production parameters, and SQL where SQL can say the same.

The operators keep their own interfaces and outputs; the queries derive digests from these.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import (
    bpe,
    chat,
    fill_middle,
    line_dedup,
    main_text,
    mixing,
    ordinal,
    periodic_runs,
    prefix_forest,
    quality_rules,
    simhash,
    token_files,
    toxicity,
)
from cohortloom.llm.checks import ORACLE_SQL
from cohortloom.llm.frames import WHITE, staged

MULTILINGUAL = bpe.Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
ENGLISH = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, cache=400_000, added=True)

TOXIC_FROM = 0.3


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = mixing.sized(docs).select(F.struct("__row.doc_id").alias("__row"), "key", "size", "u", "class")
    rows = staged(rows, "mix-sizes")
    taken = mixing.with_copies(rows, mixing.plan(rows))
    return taken.select(
        "__row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    return chat.read_back(chat.format_chats(turns.unionByName(planted)))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, MULTILINGUAL)


def op4_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prefix_forest.usable(read(spark, sf_dir, "embeddings"))
    return prefix_forest.search(rows, rows.where("vec_id % 20 = 0"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.read_documents(token_files.write_token_files(docs, ENGLISH))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, shingle=4, max_bits=4)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return ordinal.score(docs, ordinal.train(docs, read(spark, sf_dir, "labels")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.dedup_lines(docs)
    return found.select("__row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judged(docs).select("__row.doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    restored = fill_middle.restored(F.col("output"), F.col("form"))
    return fill_middle.fill_in_middle(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.collapse_runs(planted_periods(docs))
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    # Runs come by start and period, so of equal exponents the first stays.
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a),
    )
    return found.withColumns({"best": best, "lines": F.transform(lines, lambda line: F.concat(line, F.lit("\n")))}).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """Documents of which about a tenth, by a digest of their id, repeat a stretch of their words to the end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    trimmed = F.btrim("text", F.lit(WHITE))
    words = F.when((h % 10 == 0) & (trimmed != ""), F.split(trimmed, r"[\x20\x09-\x0D]+"))
    chosen = docs.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g"))
    at = chosen.withColumns({"n": F.size("words"), "a": (F.col("g") % F.size("words")).cast("int")})
    at = at.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    repeated = F.flatten(F.array_repeat(F.expr("slice(words, a + 1, p)"), F.expr("cast((n - a + p - 1) div p as int)")))
    periodic = F.concat(F.expr("slice(words, 1, a)"), F.slice(repeated, F.lit(1), F.expr("n - a")))
    text = F.when(F.col("words").isNotNull(), F.array_join(periodic, " ")).otherwise(F.col("text"))
    return at.select("doc_id", text.alias("text"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract_text(pages).withColumn("n_chars", F.length("text").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pareto_mix": op1_pareto_mix,
    "op2_chat_format": op2_chat_format,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_prefix_forest": op4_prefix_forest,
    "op5_token_files": op5_token_files,
    "op6_simhash": op6_simhash,
    "op7_ordinal_quality": op7_ordinal_quality,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_fill_middle": op11_fill_middle,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_main_text": op13_main_text,
}

__all__ = ["ORACLE_SQL", "QUERIES"]

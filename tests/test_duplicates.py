"""Duplicate marking against a plain count, by broadcast and by split, on skewed ids."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortloom.operators.duplicates import bloom_filter, bloom_mask, bloom_slot, mark_duplicates

ROWS = 60_000


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the rows share one id, a sixth has none, some ids occur a few times, the rest once."""
    n = F.col("n")
    key = (
        F.when(n % 3 == 0, F.lit("hot"))
        .when(n % 6 == 1, F.lit(None))
        .when(n % 6 == 2, F.concat(F.lit("few"), (n % 1000).cast("string")))
        .otherwise(F.concat(F.lit("one"), n.cast("string")))
    )
    path = str(tmp_path_factory.mktemp("skew") / "t")
    spark.range(0, ROWS, 1, 16).toDF("n").select(key.alias("sample_id"), n.alias("x.y")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "limits",
    [
        {},
        {"broadcast_bytes": 100},
        {"broadcast_bytes": 0},
        {"broadcast_bytes": 100, "filter_words": 3},
        {"broadcast_bytes": 0, "filter_words": 1},
    ],
    ids=["broadcast", "split", "all_cold", "many_false_positives", "one_word"],
)
def test_matches_plain_count(skewed, limits):
    rows = skewed.select("sample_id", "`x.y`").collect()
    copies = Counter(row[0] for row in rows if row[0] is not None)
    want = sorted((row[1], copies.get(row[0], 0) > 1) for row in rows)
    marked = mark_duplicates(skewed, **limits)
    assert marked.columns == ["sample_id", "x.y", "is_duplicate"]
    assert sorted((row[1], row[2]) for row in marked.collect()) == want


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_broadcast_path_shuffles_no_rows(skewed):
    plan = plan_of(mark_duplicates(skewed))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("words, least, most", [(1 << 20, 0, 40), (64, 1, ROWS // 3)])
def test_only_possible_duplicates_are_joined(skewed, words, least, most):
    """With a sort-merge join and no skew join to help, no joining task has over twice the mean.

    What is joined are the rows of ids with few copies, a sixth of all, and the filter's false positives.
    """
    spark = skewed.sparkSession
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false"}
    off |= {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in off}
    try:
        for name, value in off.items():
            spark.conf.set(name, value)
        marked = mark_duplicates(skewed, broadcast_bytes=100, filter_words=words)
        plan = plan_of(marked)
        assert "SortMergeJoin" in plan and "SinglePartition" not in plan
        counted = marked.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    scans = skewed.rdd.getNumPartitions()
    joined = [row["count"] for row in counted if row.task >= scans]
    settled = [row["count"] for row in counted if row.task < scans]
    assert sum(joined) + sum(settled) == ROWS
    assert least <= sum(joined) - ROWS // 6 <= most
    assert max(joined) < 2 * sum(joined) / len(joined) and max(settled) < 2 * sum(settled) / len(settled)


def test_filter_misses_none_and_few_others_pass(spark):
    held = spark.range(8 * 1000).selectExpr("concat('a', id) AS id")
    others = spark.range(50_000).selectExpr("concat('b', id) AS id")
    words = bloom_filter(held, "id", 1000)
    assert words.count() <= 1000

    def passed(frame):
        mask = bloom_mask(F.col("id"))
        found = frame.withColumn("__slot", bloom_slot(F.col("id"), 1000)).join(words, "__slot", "left")
        return found.where(F.col("__word").bitwiseAND(mask) == mask).count()

    assert passed(held) == 8000
    assert passed(others) < 0.05 * 50_000
    assert bloom_filter(held.selectExpr("CAST(NULL AS string) AS id"), "id", 10).count() == 0


def test_id_count_reads_one_column(skewed):
    from cohortloom.operators.duplicates import repeated_ids

    plan = plan_of(repeated_ids(skewed))
    assert "ReadSchema: struct<sample_id:string>" in plan
    assert plan.count("HashAggregate") == 2, "ids are counted before they are shuffled"

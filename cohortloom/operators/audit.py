"""Crosswalk coverage: which mapped columns were delivered, which are missing, which go unused.

Both questions come down to pairs of a name and the sides it is on. :func:`audit_mapping` pairs the names of one table in
a run; :func:`audit_deliveries` and :func:`uncovered_studies` do it for a whole catalogue as one Spark job each.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.crosswalk import SourceMapping

# Where a name belongs, by whether it was delivered and whether the crosswalk expects it.
SIDES = {(True, True): "matched", (False, True): "missing", (True, False): "unmapped"}
# Fixed value: the wording of an audit.
SUMMARY = "%s: %d mapped, %d missing %s, %d source columns unused"


@dataclass(frozen=True)
class MappingAudit:
    """The names of one study by side, each side sorted."""

    study_id: str
    names: Mapping[str, tuple[str, ...]]

    matched = property(lambda self: self.names["matched"])
    missing = property(lambda self: self.names["missing"])
    unmapped = property(lambda self: self.names["unmapped"])
    is_complete = property(lambda self: not self.names["missing"])

    def summary(self) -> str:
        sizes = {side: len(names) for side, names in self.names.items()}
        listed = list(self.names["missing"])
        return SUMMARY % (self.study_id, sizes["matched"], sizes["missing"], listed, sizes["unmapped"])


def audit_mapping(frame: DataFrame, mapping: SourceMapping) -> MappingAudit:
    """Audit one table by its column names alone; reads no rows."""
    came, wanted = frozenset(frame.columns), mapping.source_columns()
    sides: dict[str, list[str]] = {side: [] for side in SIDES.values()}
    for name in sorted(came | wanted):
        sides[SIDES[name in came, name in wanted]].append(name)
    return MappingAudit(mapping.study_id, {side: tuple(names) for side, names in sides.items()})


def expected_columns(spark: SparkSession, mappings: Iterable[SourceMapping]) -> DataFrame:
    """The registry as ``(study_id, column_name)`` rows."""
    return _pairs(spark, {m.study_id: m.source_columns() for m in mappings})


def delivered_columns(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """The deliveries' headers as ``(study_id, column_name)`` rows. A header counts also without rows below it."""
    return _pairs(spark, {study: frame.columns for study, frame in frames.items()})


def _pairs(spark: SparkSession, names: Mapping[str, Iterable[str]]) -> DataFrame:
    rows = [(study, name) for study in sorted(names) for name in sorted(names[study])]
    return spark.createDataFrame(rows, "study_id string, column_name string")


def audit_deliveries(delivered: DataFrame, expected: DataFrame) -> DataFrame:
    """Audit every delivery at once, from two ``(study_id, column_name)`` tables.

    Both sides hold names, not samples. Only studies that delivered something or have a crosswalk appear.
    """
    pairs = delivered.distinct().withColumn("came", F.lit(True)).join(
        expected.distinct().withColumn("wanted", F.lit(True)), ["study_id", "column_name"], "full"
    )

    def on_side(came: bool, wanted: bool) -> Column:
        here = (F.col("came").isNotNull() == came) & (F.col("wanted").isNotNull() == wanted)
        return F.array_sort(F.collect_list(F.when(here, F.col("column_name"))))

    audit = pairs.groupBy("study_id").agg(*(on_side(*sides).alias(name) for sides, name in SIDES.items()))
    listed = F.concat(F.lit("["), F.array_join(F.transform("missing", _quoted), ", "), F.lit("]"))
    summary = F.format_string(
        SUMMARY, "study_id", F.size("matched"), F.size("missing"), listed, F.size("unmapped")
    )
    return audit.withColumn("is_complete", F.size("missing") == 0).withColumn("summary", summary)


def _quoted(name: Column) -> Column:
    """A name as Python shows it in a list."""
    double = name.contains("'") & ~name.contains('"')
    single = F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.when(double, F.concat(F.lit('"'), name, F.lit('"'))).otherwise(F.concat(F.lit("'"), single, F.lit("'")))


def uncovered_studies(sources: DataFrame, mappings: DataFrame) -> DataFrame:
    """Studies delivered in ``sources(study_id)`` that ``mappings(study_id)`` does not know.

    Distinct before the join: a study with a third of all rows arrives at it as one row per task.
    """
    return sources.select("study_id").distinct().join(mappings.select("study_id").distinct(), "study_id", "left_anti")

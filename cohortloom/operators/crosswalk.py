"""Crosswalks: how each study's columns feed the canonical sample table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.normalizers import normalize_cells
from cohortloom.schema import CANONICAL_SCHEMA

# Which normalizer reads which canonical field; the rest is free text.
FIELD_KINDS = {
    "age_years": "age",
    "sex": "sex",
    "diagnosis": "diagnosis",
    "braak_stage": "braak",
    "cerad_score": "cerad",
    "apoe_genotype": "apoe",
    "rin": "float",
    "pmi_hours": "float",
}
# Never taken from a crosswalk: the study stamps one, the age cell decides the other.
_DERIVED = ("source_study", "age_censored")


@dataclass(frozen=True)
class SourceMapping:
    """One study's crosswalk: canonical field -> source column, plus values fixed for the whole study."""

    study_id: str
    field_map: Mapping[str, str]
    constants: Mapping[str, object] = field(default_factory=dict)
    notes: str = ""

    def source_columns(self) -> set[str]:
        return set(self.field_map.values())


# The shipped crosswalks.
MAPPINGS: dict[str, SourceMapping] = {
    mapping.study_id: mapping
    for mapping in (
        SourceMapping(
            study_id="GSE5281",
            field_map={
                "sample_id": "geo_accession",
                "subject_id": "subject",
                "age_years": "age",
                "sex": "sex",
                "diagnosis": "disease_state",
                "brain_region": "region",
                "apoe_genotype": "apoe",
            },
            constants={"platform": "Affymetrix HG-U133 Plus 2.0"},
            notes="Microarray without neuropathology: Braak stage and CERAD score stay null.",
        ),
        SourceMapping(
            study_id="GSE33000",
            field_map={
                "sample_id": "sample",
                "subject_id": "donor_id",
                "age_years": "age_at_death",
                "sex": "gender",
                "diagnosis": "dx",
                "braak_stage": "braak",
                "brain_region": "tissue",
                "pmi_hours": "pmi",
                "batch": "scan_batch",
            },
            constants={"platform": "Rosetta/Merck Human 44k"},
            notes="Ages end at '90+' (Safe Harbor): capped at 90 and marked censored. Braak stage in Roman numerals.",
        ),
        SourceMapping(
            study_id="GSE125583",
            field_map={
                "sample_id": "title",
                "subject_id": "patient",
                "age_years": "age",
                "sex": "Sex",
                "diagnosis": "diagnosis",
                "braak_stage": "braak_stage",
                "cerad_score": "cerad",
                "apoe_genotype": "apoe_genotype",
                "brain_region": "brain_region",
                "rin": "rin",
                "pmi_hours": "pmi_hrs",
                "batch": "seq_batch",
            },
            constants={"platform": "Illumina HiSeq 2500"},
            notes="CERAD score in words, APOE genotype as two bare digits.",
        ),
    )
}


def get_mapping(study_id: str) -> SourceMapping:
    if study_id not in MAPPINGS:
        raise KeyError(f"Study {study_id!r} has no crosswalk. Known studies: {', '.join(sorted(MAPPINGS))}")
    return MAPPINGS[study_id]


def harmonize(frame: DataFrame, mapping: SourceMapping) -> DataFrame:
    """One study's raw table as canonical rows.

    A narrow projection: no shuffle, and of a columnar source only mapped columns are read (delimited text is parsed whole
    to find rows that are too long). Fields without a source column are typed nulls. Source names are matched case by case in Python and read by position, so names that Spark cannot tell apart
    (``Sex``/``sex``) or would misread (dots) are safe.
    """
    positions: dict[str, int] = {}
    for position, name in enumerate(frame.columns):
        positions.setdefault(name, position)
    positional = frame.toDF(*(f"_{i}" for i in range(len(frame.columns))))

    cells = {}
    for name in CANONICAL_SCHEMA.names:
        source = mapping.field_map.get(name)
        if name not in _DERIVED and name not in mapping.constants and source in positions:
            cells[name] = (f"_{positions[source]}", FIELD_KINDS.get(name, "text"))
    table, finished = normalize_cells(positional, cells)

    outputs = {name: parts["value"] for name, parts in finished.items()}
    outputs |= {name: F.lit(value) for name, value in mapping.constants.items() if name not in _DERIVED}
    outputs["source_study"] = F.lit(mapping.study_id)
    outputs["age_censored"] = finished.get("age_years", {}).get("censored", F.lit(False))
    return table.select(
        *(outputs.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CANONICAL_SCHEMA.fields)
    )


def empty_canonical(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CANONICAL_SCHEMA)


def union_studies(spark: SparkSession, harmonized: list[DataFrame]) -> DataFrame:
    """All studies' canonical rows; a typed empty table when there are none."""
    return reduce(DataFrame.unionByName, harmonized) if harmonized else empty_canonical(spark)


def harmonize_many(
    spark: SparkSession, frames: Mapping[str, DataFrame], mappings: Mapping[str, SourceMapping]
) -> DataFrame:
    """Harmonize every study and union the results. Raises if a study has no crosswalk: none may be left out."""
    uncovered = sorted(set(frames) - set(mappings))
    if uncovered:
        raise KeyError(f"No crosswalk for: {uncovered}")
    return union_studies(spark, [harmonize(frames[study], mappings[study]) for study in sorted(frames)])

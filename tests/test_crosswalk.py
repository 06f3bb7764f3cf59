"""Harmonizing, auditing and uniting the three fixture studies."""

from __future__ import annotations

import pytest
from conftest import RAW, as_frame
from pyspark.testing import assertDataFrameEqual

from cohortloom import MAPPINGS, SourceMapping, audit_mapping, get_mapping, harmonize, harmonize_many
from cohortloom.operators.audit import audit_deliveries, delivered_columns, expected_columns, uncovered_studies
from cohortloom.schema import CANONICAL_SCHEMA


def column(frame, name, key="sample_id"):
    return [row[name] for row in sorted(frame.collect(), key=lambda row: row[key])]


def test_schema_is_exact(raw):
    for study, frame in raw.items():
        out = harmonize(frame, get_mapping(study))
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in CANONICAL_SCHEMA]
        assert out.count() == frame.count()


def test_fields_read_as_expected(raw):
    a, b, c = (harmonize(raw[s], get_mapping(s)) for s in ("GSE5281", "GSE33000", "GSE125583"))
    assert column(a, "apoe_genotype") == ["E2/E3", "E4/E4", "E3/E3", "E2/E4"]
    assert column(a, "braak_stage") == [None] * 4 and column(a, "cerad_score") == [None] * 4
    assert set(column(a, "platform")) == {"Affymetrix HG-U133 Plus 2.0"}
    assert column(a, "brain_region")[0] == "superior frontal gyrus"
    assert column(a, "age_years") == [88.0, 71.0, 66.0, 90.0]
    assert column(b, "sex") == ["F", "F", "M"]
    assert column(b, "braak_stage") == [2, 5, 3]
    assert column(b, "age_years") == [85.0, 90.0, 64.0]
    assert column(b, "age_censored") == [False, True, False]
    assert set(column(b, "source_study")) == {"GSE33000"}
    assert column(c, "cerad_score") == [3, 0, 2, 1, 0]
    assert column(c, "age_years") == [70.0, 83.0, 90.0, 59.0, 77.0]
    assert column(c, "age_censored") == [False, False, True, False, False]
    assert column(c, "pmi_hours") == [2.0, 6.5, 11.0, 3.25, 8.0]


def test_union_agrees_across_studies(spark, raw):
    union = harmonize_many(spark, raw, MAPPINGS)
    counts = {row["diagnosis"]: row["count"] for row in union.groupBy("diagnosis").count().collect()}
    assert counts == {"AD": 5, "CONTROL": 4, "MCI": 3}
    assert {row[0] for row in union.select("source_study").distinct().collect()} == set(RAW)


def test_union_of_nothing_is_typed(spark):
    out = harmonize_many(spark, {}, MAPPINGS)
    assert out.schema == CANONICAL_SCHEMA and out.count() == 0


def test_union_needs_every_crosswalk(spark, raw):
    with pytest.raises(KeyError, match="STUDY-X"):
        harmonize_many(spark, {**raw, "STUDY-X": raw["GSE5281"]}, MAPPINGS)
    with pytest.raises(KeyError, match="Known studies"):
        get_mapping("STUDY-Y")


def test_missing_columns_give_typed_nulls(raw):
    frame = raw["GSE5281"].withColumnsRenamed({"age": "age_raw", "sex": "reported", "disease_state": "status"})
    out = harmonize(frame, get_mapping("GSE5281"))
    assert column(out, "age_years") == [None] * 4
    assert column(out, "age_censored") == [False] * 4
    assert column(out, "sex") == [None] * 4 and column(out, "diagnosis") == [None] * 4


def test_constants_win_and_stamps_cannot_be_mapped(raw):
    mapping = SourceMapping(
        "X",
        {"sample_id": "geo_accession", "sex": "sex", "source_study": "region", "age_censored": "age", "batch": "subject"},
        {"sex": "Kept As Is", "age_years": 95, "source_study": "no", "rin": 7},
    )
    row = harmonize(raw["GSE5281"], mapping).orderBy("sample_id").first()
    assert (row.sex, row.age_years, row.age_censored, row.source_study) == ("Kept As Is", 95.0, False, "X")
    assert (row.rin, row.batch) == (7.0, "K7")


def test_names_spark_would_confuse(spark):
    schema = "`x.id` string, Sex string, sex string, age string, p string"
    frame = spark.createDataFrame([("a", "f", "m", "40", "s")], schema)
    mapping = SourceMapping("X", {"sample_id": "x.id", "sex": "sex", "subject_id": "p", "batch": "p", "rin": "AGE"})
    row = harmonize(frame, mapping).first()
    assert (row.sample_id, row.sex, row.subject_id, row.batch, row.rin) == ("a", "M", "s", "s", None)


def test_audit(raw):
    mapping = get_mapping("GSE5281")
    assert audit_mapping(raw["GSE5281"], mapping).is_complete
    audit = audit_mapping(raw["GSE5281"].withColumnRenamed("age", "age_raw"), mapping)
    assert not audit.is_complete
    assert audit.missing == ("age",) and audit.unmapped == ("age_raw",)
    assert audit.summary() == "GSE5281: 6 mapped, 1 missing ['age'], 1 source columns unused"


def test_catalogue_audit_agrees_with_the_single_one(spark, raw):
    raw["GSE33000"] = raw["GSE33000"].withColumnRenamed("pmi", "post mortem").withColumnRenamed("dx", "DX")
    mappings = MAPPINGS | {"Q": SourceMapping("Q", {"sex": "donor's sex", "rin": "r\"i'n", "batch": 'b"'})}
    raw["Q"] = raw["GSE5281"]
    audits = audit_deliveries(delivered_columns(spark, raw), expected_columns(spark, mappings.values())).collect()
    assert len(audits) == 4
    for row in audits:
        single = audit_mapping(raw[row.study_id], mappings[row.study_id])
        assert (tuple(row.matched), tuple(row.missing), tuple(row.unmapped), row.is_complete, row.summary) == (
            single.matched,
            single.missing,
            single.unmapped,
            single.is_complete,
            single.summary(),
        )


def test_header_counts_without_rows(spark, raw):
    headers = {study: frame.where("false") for study, frame in raw.items()}
    audits = audit_deliveries(delivered_columns(spark, headers), expected_columns(spark, MAPPINGS.values()))
    assert {row.study_id: row.is_complete for row in audits.collect()} == dict.fromkeys(MAPPINGS, True)
    nothing = audit_deliveries(delivered_columns(spark, {}), expected_columns(spark, MAPPINGS.values()))
    assert {row.study_id: len(row.missing) for row in nothing.collect()} == {
        study: len(mapping.field_map) for study, mapping in MAPPINGS.items()
    }


def test_uncovered_studies(spark):
    sources = spark.createDataFrame([("A",), ("B",), ("B",), ("C",)], "study_id string")
    known = spark.createDataFrame([("A",), ("D",)], "study_id string")
    assertDataFrameEqual(
        uncovered_studies(sources, known), spark.createDataFrame([("B",), ("C",)], "study_id string")
    )


def test_plan_is_a_narrow_projection_without_python(raw):
    plan = harmonize(raw["GSE33000"], get_mapping("GSE33000"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_unused_columns_are_not_read(spark, tmp_path):
    as_frame(spark, RAW["GSE125583"]).write.parquet(str(tmp_path / "c"))
    out = harmonize(spark.read.parquet(str(tmp_path / "c")), get_mapping("GSE125583")).select("sex", "source_study")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Sex:string>" in plan


def test_regexes_are_not_copied_into_branches(spark, tmp_path):
    as_frame(spark, RAW["GSE125583"]).write.parquet(str(tmp_path / "c"))
    out = harmonize(spark.read.parquet(str(tmp_path / "c")), get_mapping("GSE125583"))
    # A filter on normalized columns must not be rewritten to the raw ones either.
    out = out.where("diagnosis = 'AD' AND cerad_score > 1")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("suspected") == 1 and plan.count("neuritic") == 1


def test_harmonized_tables_can_meet_themselves(raw):
    """The fences' row counts are named per table, so joins and unions of one table with itself stay legal."""
    out = harmonize(raw["GSE5281"], get_mapping("GSE5281"))
    assert out.alias("a").join(out.alias("b"), "sample_id").count() == 4
    assert out.unionByName(out.where("sex = 'M'")).count() == 6

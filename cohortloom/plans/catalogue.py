"""A query per operator, over whole benchmark tables. Each takes ``(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import normalizers as N
from cohortloom.functions.text import is_blank, normalize_text
from cohortloom.operators.audit import audit_deliveries, expected_columns, uncovered_studies
from cohortloom.operators.crosswalk import MAPPINGS, get_mapping, harmonize, harmonize_many, union_studies
from cohortloom.operators.duplicates import mark_duplicates
from cohortloom.operators.rules import RULES, Severity, rules_named
from cohortloom.operators.validate import ValidationReport, rule_masks, validate
from cohortloom.plans.cohorts import COHORTS, OUTLIERS, cohort, cohorts, outliers, table
from cohortloom.plans.run import DEFAULT_MIN_PASS_RATE, run_all
from cohortloom.sources.delimited import read_delimited
from cohortloom.sources.lake import BRONZE, Lake
from cohortloom.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

CSV_OUT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
FILES = {study: f"{study}_metadata.csv" for study in COHORTS}
# Raw column per study that feeds a kind of field.
RAW_FIELDS = {
    "sex": {"GSE5281": "sex", "GSE33000": "gender", "GSE125583": "Sex"},
    "diagnosis": {"GSE5281": "disease_state", "GSE33000": "dx", "GSE125583": "diagnosis"},
    "age": {"GSE5281": "age", "GSE33000": "age_at_death", "GSE125583": "age"},
    "braak": {"GSE33000": "braak", "GSE125583": "braak_stage"},
    "cerad": {"GSE125583": "cerad"},
    "apoe": {"GSE5281": "apoe", "GSE125583": "apoe_genotype"},
    "float": {"GSE33000": "pmi", "GSE125583": "rin"},
}
# How a whole table of the third study is normalized in place.
TABLE_KINDS = {
    "title": "text",
    "age": "age",
    "Sex": "sex",
    "diagnosis": "diagnosis",
    "braak_stage": "braak",
    "cerad": "cerad",
    "apoe_genotype": "apoe",
    "brain_region": "text",
    "rin": "float",
    "pmi_hrs": "float",
}
SUBSET = ("braak_out_of_range", "degraded_rna", "missing_age")
FLAG_NAMES = tuple(rule.name for rule in RULES if rule.severity is Severity.FLAG)
RULE_GROUPS = {
    "rule_missing_required": ("missing_sample_id", "missing_source_study", "missing_diagnosis"),
    "rule_vocabulary": ("diagnosis_not_recognized",),
    "rule_ranges": (
        "age_out_of_range",
        "braak_out_of_range",
        "cerad_out_of_range",
        "rin_out_of_range",
        "pmi_out_of_range",
    ),
    "rule_flags": FLAG_NAMES,
}
STUDY_PICKS = ("GSE5281", "STUDY-X1", "GSE33000", "GSE125583", "STUDY-X2")


# --- sources -------------------------------------------------------------------------------------------------------


def bronze_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The three cohorts delivered as CSV, side by side, into a new lake in the shared scratch folder."""
    lake = Lake.at(spark, scratch_path(spark, "lake"))
    sent = cohorts(spark, sf_dir)
    with ThreadPoolExecutor(max_workers=len(sent)) as pool:
        writes = [
            pool.submit(frame.write.options(**CSV_OUT).csv, lake.path(BRONZE, FILES[study])) for study, frame in sent.items()
        ]
        for write in writes:
            write.result()
    return lake


def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake.at(spark, scratch_path(spark, "lake"))
    cohort(spark, sf_dir, "GSE33000").write.options(**CSV_OUT).csv(lake.path(BRONZE, FILES["GSE33000"]))
    return lake.read_csv(BRONZE, FILES["GSE33000"])


def bronze_scan_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    table(spark, sf_dir, "documents").select("doc_id", "text", "lang").write.options(**CSV_OUT).csv(path)
    return read_delimited(spark, path)


def layer_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of a bronze layer in order, hidden ones too, and again under a prefix."""
    lake = Lake.at(spark, scratch_path(spark, "lake"))
    for study, frame in cohorts(spark, sf_dir).items():
        frame.coalesce(1).write.options(**CSV_OUT).csv(lake.path(BRONZE, FILES[study]))

    def listed(prefix: str) -> DataFrame:
        files = lake.list_files(BRONZE, prefix).agg(F.collect_list(F.struct("path", "length")).alias("files"))
        each = files.select(F.posexplode("files").alias("position", "file"))
        # Spark's file names hold a random part.
        name = F.regexp_replace("file.path", "part-([0-9]+)-[0-9a-f-]{36}-c000", "part-$1")
        return each.select(F.lit(prefix).alias("prefix"), "position", name.alias("path"), F.col("file.length") > 0)

    return listed("").union(listed("GSE33000_m")).toDF("prefix", "position", "path", "has_bytes")


# --- normalizers ---------------------------------------------------------------------------------------------------


def is_blank_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    def profile(study: str) -> DataFrame:
        frame = cohort(spark, sf_dir, study)
        counts = frame.agg(*(F.count_if(is_blank(F.col(name))).alias(name) for name in frame.columns))
        pairs = F.array(
            *(F.struct(F.lit(name).alias("column_name"), F.col(name).alias("blanks")) for name in frame.columns)
        )
        return counts.select(F.lit(study).alias("study_id"), F.inline(pairs))

    return profile("GSE5281").unionByName(profile("GSE33000"))


def normalized_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", normalize_text(F.col("text")).alias("text"))


def _field_query(kind: str) -> Query:
    def one(spark: SparkSession, sf_dir: str, study: str, column: str) -> DataFrame:
        frame = cohort(spark, sf_dir, study).select(
            F.lit(study).alias("study_id"),
            F.col(MAPPINGS[study].field_map["sample_id"]).alias("sample"),
            F.col(column).alias("raw"),
            F.col(column).alias("value"),
        )
        return frame.transform(N.normalize_columns({"value": kind}))

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reduce(
            DataFrame.unionByName, [one(spark, sf_dir, study, column) for study, column in RAW_FIELDS[kind].items()]
        )

    return query


def normalized_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort(spark, sf_dir, "GSE125583").transform(N.normalize_columns(TABLE_KINDS))


# --- crosswalks ----------------------------------------------------------------------------------------------------


def _cohort_query(study: str) -> Query:
    return lambda spark, sf_dir: harmonize(cohort(spark, sf_dir, study), get_mapping(study))


def harmonize_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = {"age": "age_raw", "sex": "reported_sex", "disease_state": "status"}
    return harmonize(cohort(spark, sf_dir, "GSE5281").withColumnsRenamed(renamed), get_mapping("GSE5281"))


def harmonized_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonize_many(spark, cohorts(spark, sf_dir), MAPPINGS)


def harmonize_empty_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union of no studies is typed: it joins a harmonized cohort without adding a row or changing a column."""
    return union_studies(spark, []).unionByName(harmonize(cohort(spark, sf_dir, "GSE5281"), get_mapping("GSE5281")))


def mapping_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers as delivered in a lake, one of them without rows, held against the registry."""
    lake = Lake.at(spark, scratch_path(spark, "lake"))
    sent = {
        "GSE5281": cohort(spark, sf_dir, "GSE5281").withColumn("scanner_model", F.lit("x")),
        "GSE33000": cohort(spark, sf_dir, "GSE33000").withColumnsRenamed({"pmi": "post_mortem", "dx": "DX"}),
        "GSE125583": cohort(spark, sf_dir, "GSE125583").where(F.lit(False)),
    }
    for study, frame in sent.items():
        frame.write.options(**CSV_OUT).csv(lake.path(BRONZE, FILES[study]))
    delivered = lake.headers(BRONZE, {study: FILES[study] for study in sent})
    audit = audit_deliveries(delivered, expected_columns(spark, MAPPINGS.values()))
    return audit.withColumns({name: F.array_join(name, ",") for name in ("matched", "missing", "unmapped")})


def unmapped_studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    study = F.element_at(F.array(*map(F.lit, STUDY_PICKS)), (F.col("o_orderkey") % len(STUDY_PICKS) + 1).cast("int"))
    sources = table(spark, sf_dir, "orders").select(study.alias("study_id"))
    return uncovered_studies(sources, spark.createDataFrame([(s,) for s in sorted(MAPPINGS)], "study_id string"))


# --- rules and verdicts --------------------------------------------------------------------------------------------


def mixed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules look at: the harmonized cohorts, and rows that break every rule."""
    columns = ["sample_id", *OUTLIERS]
    return harmonized_union(spark, sf_dir).select(*columns).unionByName(outliers(spark, sf_dir))


def _masks_query(*names: str) -> Query:
    rules = rules_named(*names) if names else RULES
    return lambda spark, sf_dir: rule_masks(mixed_batch(spark, sf_dir), rules)


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", "l_orderkey", "l_linenumber").alias("sample_id"), "l_partkey"
    )


def duplicate_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_duplicates(_line_items(spark, sf_dir))


def duplicate_line_items_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where the repeated ids don't fit a broadcast: a tenth of the rows share one id, some have none."""
    key = F.when(F.col("l_partkey") % 10 == 0, "many").when(F.col("l_partkey") % 11 != 0, F.col("sample_id"))
    items = _line_items(spark, sf_dir).withColumn("sample_id", key)
    return mark_duplicates(items, broadcast_bytes=100)


def _validated(spark: SparkSession, sf_dir: str) -> ValidationReport:
    return validate(mixed_batch(spark, sf_dir))


def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = F.when(F.col("is_clean"), "silver").otherwise("quarantine")
    return _validated(spark, sf_dir).routed().select("sample_id", "source_study", layer.alias("layer"), "detail")


def validate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).quarantined.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("samples"))


def validate_rule_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = validate(mixed_batch(spark, sf_dir), rules_named(*SUBSET))
    return report.clean.select("sample_id", "diagnosis", "quality_flags")


def validate_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    unkeyed = cohort(spark, sf_dir, "GSE5281").where("geo_accession IS NULL")
    return validate(harmonize(unkeyed, get_mapping("GSE5281"))).rule_count_table()


def rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).rule_count_table()


def pass_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(harmonized_union(spark, sf_dir)).pass_rate_table()


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pass_rates(spark, sf_dir).select("pass_rate", (F.col("pass_rate") >= DEFAULT_MIN_PASS_RATE).alias("passed"))


# --- consumers -----------------------------------------------------------------------------------------------------


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(harmonized_union(spark, sf_dir)).clean


def diagnosis_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).groupBy("diagnosis").agg(F.count(F.lit(1)).alias("samples"))


def has_flag(name: str) -> Column:
    return F.array_contains(F.split("quality_flags", ";"), name)


def flagged_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    degraded = silver(spark, sf_dir).where(has_flag("degraded_rna"))
    return degraded.select("sample_id", "source_study", "rin", "quality_flags")


def distinct_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).select("source_study", "diagnosis", "sex").distinct()


def flagship_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cohorts harmonized, validated and summed up by study and diagnosis."""
    return (
        silver(spark, sf_dir)
        .groupBy("source_study", "diagnosis")
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.count_if("age_censored").alias("censored_ages"),
            F.min("age_years").alias("youngest"),
            F.max("age_years").alias("oldest"),
            F.max("braak_stage").alias("highest_stage"),
            F.count("apoe_genotype").alias("genotyped"),
            *(F.count_if(has_flag(name)).alias(name) for name in FLAG_NAMES),
        )
    )


# --- whole runs ----------------------------------------------------------------------------------------------------


def _published(spark: SparkSession, sf_dir: str) -> Lake:
    lake = bronze_lake(spark, sf_dir)
    run_all(lake, FILES, run_id="0012")
    return lake


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir).read_silver()


def quarantine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir).read_quarantine()


def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All a published run's manifest says, but for its times, its attempt and the folder of its lake."""
    texts, counts = "map<string,string>", "map<string,bigint>"
    fields = (
        f"run_id:string,started_at:string,finished_at:string,studies:array<string>,source_paths:{texts},"
        f"mapping_audit:{texts},mapping_notes:{texts},rule_counts:{counts},rows_in:bigint,rows_clean:bigint,"
        "rows_quarantined:bigint,silver_path:string,quarantine_path:string"
    )
    record = _published(spark, sf_dir).read_manifests()
    m = record.select(F.from_json("manifest_json", f"struct<{fields}>").alias("m")).select("m.*")

    def named(name: str, column: Column) -> Column:
        return F.transform_keys(column, lambda key, _: F.concat(F.lit(f"{name}:"), key))

    def folder(path: str) -> Column:
        return F.regexp_extract(path, "(silver|quarantine)/samples/run_id=[^/]*", 0)

    single = {
        "run_id": F.col("run_id"),
        "studies": F.array_join("studies", ","),
        "is_timed": (F.to_timestamp("started_at") <= F.to_timestamp("finished_at")).cast("string"),
        "rows_in": F.col("rows_in").cast("string"),
        "rows_clean": F.col("rows_clean").cast("string"),
        "rows_quarantined": F.col("rows_quarantined").cast("string"),
        "silver_path": folder("silver_path"),
        "quarantine_path": folder("quarantine_path"),
    }
    whole = F.map_from_arrays(F.array(*map(F.lit, single)), F.array(*single.values()))
    rules = F.transform_values("rule_counts", lambda _, n: n.cast("string"))
    nested = [named(name, F.col(name)) for name in ("source_paths", "mapping_audit", "mapping_notes")]
    return m.select(F.explode(F.map_concat(whole, *nested, named("rule_counts", rules))).alias("measure", "value"))


QUERIES: dict[str, Query] = {
    "flagship_summary": flagship_summary,
    "bronze_scan": bronze_scan,
    "bronze_scan_multiline": bronze_scan_multiline,
    "layer_inventory": layer_inventory,
    "is_blank_profile": is_blank_profile,
    "normalize_text": normalized_documents,
    **{f"normalize_{kind}": _field_query(kind) for kind in RAW_FIELDS},
    "normalize_table": normalized_table,
    "harmonize_cohort_a": _cohort_query("GSE5281"),
    "harmonize_cohort_b": _cohort_query("GSE33000"),
    "harmonize_cohort_c": _cohort_query("GSE125583"),
    "harmonize_missing_column": harmonize_missing_column,
    "harmonize_union": harmonized_union,
    "harmonize_empty_union": harmonize_empty_union,
    "mapping_audit": mapping_audit,
    "unmapped_studies": unmapped_studies,
    "rule_masks": _masks_query(),
    **{name: _masks_query(*rules) for name, rules in RULE_GROUPS.items()},
    "rule_duplicate_sample_id": duplicate_line_items,
    "rule_duplicate_split": duplicate_line_items_split,
    "validate_split": validate_split,
    "validate_reasons": validate_reasons,
    "validate_rule_subset": validate_rule_subset,
    "validate_empty": validate_empty,
    "rule_counts": rule_counts,
    "pass_rate": pass_rates,
    "quality_gate": quality_gate,
    "diagnosis_counts": diagnosis_counts,
    "flagged_samples": flagged_samples,
    "distinct_vocab": distinct_vocab,
    "silver_roundtrip": silver_roundtrip,
    "quarantine_roundtrip": quarantine_roundtrip,
    "run_manifest": run_manifest,
}

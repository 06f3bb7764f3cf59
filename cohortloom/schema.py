"""The canonical sample table: column order, Spark types, vocabularies and bounds."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical columns, in output order, with their Spark types.
CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("source_study", T.StringType()),
        T.StructField("subject_id", T.StringType()),
        T.StructField("age_years", T.DoubleType()),
        T.StructField("age_censored", T.BooleanType()),
        T.StructField("sex", T.StringType()),
        T.StructField("diagnosis", T.StringType()),
        T.StructField("braak_stage", T.LongType()),
        T.StructField("cerad_score", T.LongType()),
        T.StructField("apoe_genotype", T.StringType()),
        T.StructField("brain_region", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("rin", T.DoubleType()),
        T.StructField("pmi_hours", T.DoubleType()),
        T.StructField("batch", T.StringType()),
    ]
)
CANONICAL_COLUMNS = tuple(CANONICAL_SCHEMA.names)

# Columns a silver row must carry.
REQUIRED_COLUMNS = ("sample_id", "source_study", "diagnosis")

# Controlled vocabularies.
SEX_VALUES = ("M", "F", "unknown")
DIAGNOSES = ("AD", "MCI", "CONTROL", "OTHER", "UNKNOWN")

# Inclusive bounds, the age cap and the flag thresholds.
BOUNDS = {
    "age_years": (0.0, 120.0),
    "braak_stage": (0, 6),
    "cerad_score": (0, 3),
    "rin": (1.0, 10.0),
    "pmi_hours": (0.0, 120.0),
}
AGE_CAP = 90.0
DEGRADED_RIN = 5.0
YOUNG_AGE = 40.0

SILVER_SCHEMA = T.StructType([*CANONICAL_SCHEMA.fields, T.StructField("quality_flags", T.StringType())])
QUARANTINE_SCHEMA = T.StructType([*CANONICAL_SCHEMA.fields, T.StructField("quarantine_reason", T.StringType())])
MANIFEST_SCHEMA = T.StructType(
    [T.StructField("run_id", T.StringType()), T.StructField("manifest_json", T.StringType())]
)

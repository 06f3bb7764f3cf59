"""Messy cohorts derived from the benchmark tables, in the raw layouts of the three shipped crosswalks.

Every cell is picked from a fixed vocabulary by integer arithmetic on the row's key. The factors share no divisor with
the vocabulary sizes, so each spelling occurs. The same definitions, as text, feed the DuckDB checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Per cohort the source table, the key, and each raw column as a SQL expression or a vocabulary with the factor of the key
# that picks from it. The names of the studies and columns. The cells are made up.
COHORTS = {
    "GSE5281": (
        "customer",
        "c_custkey",
        {
            "geo_accession": "concat('GSM', 700000 + k)",
            "subject": "c_name",
            "age": (7, ["54", "71 yr", "88.5", "102", "-3", "elderly", "NA", "41,25", "90", "33"]),
            "sex": (5, ["f", "MAN", "woman", "both", "Male.", "  F ", "?"]),
            "disease_state": (
                3,
                [
                    "definite AD",
                    "healthy control",
                    " Alzheimers  type ",
                    "some cognitive impairment",
                    "Parkinson's disease",
                    "lost to follow-up",
                    "-",
                ],
            ),
            "region": (1, ["putamen", "  superior   frontal gyrus ", "unknown"]),
            "apoe": (11, ["E2/E3", "e4 e4", "2-4", "3 3", "carrier of 4", "22", "?"]),
        },
    ),
    "GSE33000": (
        "orders",
        "o_orderkey",
        {
            "sample": "CASE WHEN k % 89 = 0 THEN '' WHEN k % 90 = 1 THEN concat('DLP-', k - 1) "
            "ELSE concat('DLP-', k) END",
            "donor_id": "concat('N', o_custkey)",
            "age_at_death": (5, ["89+", "90 or more", "72.5", "81 y", ">90", "not known", "175", "69"]),
            "gender": (1, ["1", "2", "0", "3"]),
            "dx": (3, ["LOAD", "nondemented", "ci", "hc", "possible AD"]),
            "braak": (7, ["Braak I", "stage VI", "II/III", "5", "iv to v", "NFT 3", "-", "12", "0", "VII"]),
            "tissue": "'frontal pole'",
            "pmi": (5, ["7.25", "19", "3 h", "740", "-2.5", "14,5 hours", "missing"]),
            "scan_batch": "concat('Q', 1 + k % 4)",
        },
    ),
    "GSE125583": (
        "events",
        "event_id",
        {
            "title": "concat('FUS-', k)",
            "patient": "concat('W', user_id)",
            "age": (5, ["63", "101", "86 years", "37", "90+", "72-75", "18"]),
            "Sex": (3, ["man", "FEMALE", "2", "n/k", "m"]),
            "diagnosis": (
                5,
                [
                    "suspected alzheimer disease",
                    "cognitively unimpaired",
                    "mci",
                    "vascular dementia",
                    "progressive supranuclear palsy",
                    "ad",
                ],
            ),
            "braak_stage": (7, ["B-III", "6", "Braak score 1", "ii", "stage unknown"]),
            "cerad": (3, ["severe", "zero", "mild plaques", "3", "CERAD 1", "7", "neuritic frequent"]),
            "apoe_genotype": (2, ["e3e3", "24", "4/4", "32", "3|4"]),
            "brain_region": "'fusiform gyrus'",
            "rin": "concat((10 + 17 * k % 98) DIV 10, '.', (10 + 17 * k % 98) % 10)",
            "pmi_hrs": (3, ["2.75 hours", "6", "13 hr", "260", "8.4"]),
            "seq_batch": "concat('T', 1 + k % 3)",
        },
    ),
}

# Canonical rows that no normalizer would give, so that every rule fires; one per line item.
OUTLIERS = {
    "source_study": ("string", 1, ["GSE5281", "GSE33000", None, "", "GSE125583"]),
    "diagnosis": ("string", 3, ["AD", "MCI", "CONTROL", "OTHER", "UNKNOWN", "not-a-real-dx", None, " "]),
    "age_years": ("double", 7, ["80", "200", "0", "120", "120.5", "-1", "12", "39.5", None, "NaN", "40"]),
    "braak_stage": ("bigint", 4, ["0", "1", "6", "7", "5", None, "9", "-1", "3"]),
    "cerad_score": ("bigint", 3, ["0", "3", "4", None, "-1"]),
    "rin": ("double", 7, ["1", "10", "10.5", "4.5", "5", None, "NaN", "0.5", "8"]),
    "pmi_hours": ("double", 5, ["0", "120", "120.5", None, "500", "-0.5", "NaN"]),
}
OUTLIER_KEY = "l_orderkey * 8 + l_linenumber"
OUTLIER_ID = (
    "CASE WHEN k % 53 = 0 THEN NULL WHEN k % 59 = 0 THEN '   ' ELSE concat(l_orderkey, '_', l_linenumber) END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(factor: int, vocabulary: list[str | None]) -> str:
    words = ", ".join("NULL" if word is None else '"' + word + '"' for word in vocabulary)
    return f"element_at(array({words}), cast(pmod(k * {factor}, {len(vocabulary)}) + 1 AS int))"


def cohort(spark: SparkSession, sf_dir: str, study: str) -> DataFrame:
    """One raw cohort: all-string columns in the study's own layout, a row per row of its source table."""
    source, key, columns = COHORTS[study]
    cells = (f"{spec if isinstance(spec, str) else _pick(*spec)} AS `{name}`" for name, spec in columns.items())
    return table(spark, sf_dir, source).selectExpr("*", f"{key} AS k").selectExpr(*cells)


def cohorts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {study: cohort(spark, sf_dir, study) for study in COHORTS}


def outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical columns holding values that only outside data would have."""
    cells = (f"cast({_pick(factor, words)} AS {dtype}) AS {name}" for name, (dtype, factor, words) in OUTLIERS.items())
    keyed = table(spark, sf_dir, "lineitem").selectExpr("*", f"{OUTLIER_KEY} AS k")
    return keyed.selectExpr(f"{OUTLIER_ID} AS sample_id", *cells)

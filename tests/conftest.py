"""One local session for all tests, and three tiny deliveries that disagree in every convention."""

from __future__ import annotations

import csv
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortloom.sources.lake import Lake  # noqa: E402

# The column names. The samples are made up.
RAW = {
    "GSE5281": {
        "geo_accession": ["GSM700101", "GSM700102", "GSM700103", "GSM700104"],
        "subject": ["K7", "K8", "K9", "K10"],
        "age": ["88", "71 yrs", "66", "92"],
        "sex": ["woman", "female", "1", "m"],
        "disease_state": ["healthy", "probable AD", "MCI", "alzheimers"],
        "region": ["superior  frontal gyrus", "hippocampus", "putamen", "putamen"],
        "apoe": ["e2/e3", "44", "3/3", "24"],
    },
    "GSE33000": {
        "sample": ["DLP_11", "DLP_12", "DLP_13"],
        "donor_id": ["N5", "N6", "N7"],
        "age_at_death": ["85", "90 or older", "64 yrs"],
        "gender": ["2", "2", "1"],
        "dx": ["ctrl", "LOAD", "ci"],
        "braak": ["II", "V", "III-IV"],
        "tissue": ["cerebellum"] * 3,
        "pmi": ["4.25", "10 hrs", "20"],
        "scan_batch": ["Q2", "Q1", "Q1"],
    },
    "GSE125583": {
        "title": ["FUS_01", "FUS_02", "FUS_03", "FUS_04", "FUS_05"],
        "patient": ["W1", "W2", "W3", "W4", "W5"],
        "age": ["70", "83", "91", "59", "77"],
        "Sex": ["man", "F", "woman", "xy", "male"],
        "diagnosis": ["AD", "cognitively normal", "Alzheimer's", "mci", "hc"],
        "braak_stage": ["VI", "I", "stage 4", "2", "Braak 0"],
        "cerad": ["severe", "zero", "moderate", "mild", "0"],
        "apoe_genotype": ["33", "23", "34", "44", "32"],
        "brain_region": ["fusiform gyrus"] * 5,
        "rin": ["8.1", "9.0", "6.6", "4.4", "7.3"],
        "pmi_hrs": ["2", "6.5 hours", "11", "3.25", "8"],
        "seq_batch": ["T1", "T1", "T2", "T2", "T3"],
    },
}
FILES = {study: f"{study}_metadata.csv" for study in RAW}


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("cohortloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def as_rows(columns: dict[str, list]) -> list[tuple]:
    return list(zip(*columns.values(), strict=True))


def as_frame(spark, columns: dict[str, list]):
    return spark.createDataFrame(as_rows(columns), ", ".join(f"`{name}` string" for name in columns))


def write_csv(path: Path, columns: dict[str, list]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(columns)
        writer.writerows(as_rows(columns))


@pytest.fixture
def raw(spark):
    return {study: as_frame(spark, columns) for study, columns in RAW.items()}


@pytest.fixture
def lake(spark, tmp_path):
    for study, columns in RAW.items():
        write_csv(tmp_path / "bronze" / FILES[study], columns)
    return Lake.at(spark, str(tmp_path))

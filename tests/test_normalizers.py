"""Accepted spellings and pinned quirks, one table per normalizer."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import normalizers as N
from cohortloom.functions import text

# The spellings that are accepted and what they mean. Free texts are made up.
UNKNOWN_AGE = (None, False)
CAPPED = (90.0, True)

VECTORS = {
    "is_blank": (
        text.is_blank,
        {
            True: [None, "", "   ", "NA", "n/a", "NaN", "none", "NULL", "-", "--", ".", "not reported", "unknown"]
            + [" na ", "\x1cUNK\x1f", "No Data", "not applicable\n"],
            False: ["0", "AD", "control", "3.5", "III", "not  reported", "none.", "​na", "x" * 10_000],
        },
    ),
    "text": (
        text.normalize_text,
        {
            "locus coeruleus": ["\t locus \n coeruleus  ", "locus\u00a0 coeruleus", "\u2028locus\x1f coeruleus"],
            "Aa": ["Aa", " Aa"],
            None: ["  ", "NA", None],
            "not reported x": ["not  reported\tx"],
        },
    ),
    "sex": (
        N.normalize_sex,
        {
            "M": ["M", "m", "male", "Male", "MALE", "1", "man", "xy", " xy ", "male..", "M."],
            "F": ["F", "f", "female", "Female.", "2", "woman", " XX"],
            "unknown": [None, "", "NA", "other", "not recorded", "9", "1.0", "male .", "."],
        },
    ),
    "diagnosis": (
        N.normalize_diagnosis,
        {
            "AD": ["AD", "ad", "Alzheimer's disease", "Alzheimer Disease", "ALZHEIMERS", "probable AD", "LOAD", "eoad"]
            + ["Alzheimer’s", "Alzheimer's and Lewy body", "possible \t AD", "suspected alzheimer", "A'D"],
            "MCI": ["MCI", "mci", "mild cognitive impairment", "Mild  Cognitive Impairment", "no cognitive impairment"]
            + ["ci", "definite mci"],
            "CONTROL": ["control", "Control", "CTRL", "normal", "non-demented", "cognitively normal", "NC"]
            + ["healthy control", "amyloid seen, no dementia", "cognitively unimpaired", "possible hc"],
            "OTHER": ["a frontotemporal type", "with Lewy bodies", "Vascular  dementia, late", "lost to follow-up"]
            + ["CBD corticobasal syndrome", "progressive supranuclear palsy", "non demented", "MCI due to AD", "sporadic AD", "probable AD."]
            + ["dementia", "parkinson", "n'a", "probable probable ad", "probable"],
            "UNKNOWN": [None, "NA", "", " Unknown "],
        },
    ),
    "age": (
        lambda c: F.struct(N.normalize_age(c).alias("v"), N.age_censored(c).alias("c")),
        {
            (78.0, False): ["78", "78 years", "78 yrs", "78 y/o", "78yo", " 78 "],
            (78.5, False): ["78.5", "78,5", "７８.５"],
            CAPPED: ["90+", "90 or older", "90 or above", ">89", ">90", "89+", "94", "190+", "90 OR MORE", "> 89", "90.1"]
            + ["1" * 400, "90 +", "1000"],
            (90.0, False): ["90", "90 years or older", "over 90", "≥90"],
            UNKNOWN_AGE: [None, "", "NA", "unknown", "adult", "-", "."],
            (5.0, False): [".5"],
            (1.0, False): ["1e3"],
            (1.234, False): ["1,234"],
            (60.0, False): ["60-70"],
            (-5.0, False): ["-5"],
        },
    ),
    "braak": (
        N.normalize_braak,
        {
            0: ["0", "stage 0"],
            1: ["I", "-1", "1"],
            2: ["ii", "Braak NFT stage II", "B2"],
            3: ["III", "3", "Braak III", "III-IV", "3-4", "III/IV", "iii to iv", "III or IV", "3.5", "iii & iv"],
            4: ["IV", "braak stage IV", "stage4", "IV or V"],
            5: ["V", "stage 5", "５"],
            6: ["VI", "6", "VI-V", "vi."],
            9: ["9"],
            None: [None, "", "NA", "not assessed", "n/a", "IIIa", "BraakV", "(IV)", "III–IV", "none", "9" * 30],
        },
    ),
    "cerad": (
        N.normalize_cerad,
        {
            0: ["0", "none", "CERAD none", "zero", "none.", " NONE "],
            1: ["1", "sparse", "mild", "-1", "neuritic plaques sparse"],
            2: ["2", "moderate"],
            3: ["3", "frequent", "severe", "C3", "CERAD score: 3"],
            5: ["5"],
            None: ["NA", "n/a", "not assessed", "not reported", "", None, "no plaques", "unknown"],
        },
    ),
    "apoe": (
        N.normalize_apoe,
        {
            "E3/E3": ["33", "3/3", "E3/E3", "e3e3"],
            "E3/E4": ["34", "43", "4/3", "E4/E3", "apoe 3/4"],
            "E2/E3": ["23", "32"],
            "E4/E4": ["44"],
            "E2/E2": ["2 2"],
            None: [None, "NA", "carrier of E4", "unknown", "3", "234", "apoe4", ""],
        },
    ),
    "float": (
        N.normalize_float,
        {
            7.2: ["7.2", "7,2", " 7.2h"],
            7.0: ["7"],
            4.5: ["4.5 hours", "about 4.5"],
            12.0: ["12 hrs", "12h"],
            -1.5: ["-1.5"],
            None: ["NA", None, "", "hours"],
            float("inf"): ["9" * 400],
        },
    ),
}


@pytest.mark.parametrize("name", VECTORS)
def test_vectors(spark, name):
    build, expected = VECTORS[name]
    cases = [(cell, want) for want, cells in expected.items() for cell in cells]
    frame = spark.createDataFrame([(i, cell) for i, (cell, _) in enumerate(cases)], "i int, cell string")
    got = {row.i: row.got for row in frame.select("i", build(F.col("cell")).alias("got")).collect()}
    wrong = []
    for i, (cell, want) in enumerate(cases):
        value = tuple(got[i]) if isinstance(want, tuple) else got[i]
        if value != want:
            wrong.append((cell, want, value))
    assert not wrong


def test_numbers_are_read_as_their_text(spark):
    frame = spark.createDataFrame([(0, 3.5), (1, float("nan")), (None, None)], "n int, x double")
    rows = frame.select(text.is_blank(F.col("n")).alias("n"), text.is_blank(F.col("x")).alias("x")).collect()
    assert [(r.n, r.x) for r in rows] == [(False, False), (False, True), (True, True)]
    assert [r[0] for r in frame.select(N.normalize_float(F.col("x"))).collect()] == [3.5, None, None]


def test_long_whitespace_runs_stay_linear(spark):
    frame = spark.createDataFrame([("a" + " \t" * 200_000 + "b",)], "t string")
    assert frame.select(text.normalize_text(F.col("t"))).first()[0] == "a b"


def test_normalize_columns_in_place(spark):
    frame = spark.createDataFrame([("k", "94", "F", "43")], "`id.x` string, age string, Sex string, apoe string")
    out = frame.transform(N.normalize_columns({"age": "age", "Sex": "sex", "apoe": "apoe"}))
    assert out.columns == ["id.x", "age", "age_censored", "Sex", "apoe"]
    assert tuple(out.first()) == ("k", 90.0, True, "F", "E3/E4")
    cold = frame.transform(N.normalize_columns({"age": "age"}, where="Sex = 'M'"))
    assert cold.columns == ["id.x", "age", "age_censored", "Sex", "apoe"] and cold.count() == 0
    with pytest.raises(KeyError, match="nope"):
        frame.transform(N.normalize_columns({"nope": "age"}))


def test_filters_on_other_columns_reach_the_scan(spark, tmp_path):
    rows = [(str(k), f"{40 + k}", "F", k % 3) for k in range(9)]
    frame = spark.createDataFrame(rows, "id string, age string, sex string, day int")
    frame.write.partitionBy("day").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    kept = table.transform(N.normalize_columns({"age": "age", "sex": "sex"}, where="day = 1 AND id = '4'"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "EqualTo(id,4)" in plan
    assert [(r.id, r.age, r.day) for r in kept.collect()] == [("4", 44.0, 1)]


def test_filters_on_the_result_reach_the_scan(spark, tmp_path):
    rows = [(str(k), f"{40 + k}", "F" if k < 6 else None, k % 3) for k in range(9)]
    frame = spark.createDataFrame(rows, "id string, age string, sex string, day int")
    frame.write.partitionBy("day").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t")).transform(N.normalize_columns({"age": "age", "sex": "sex"}))

    kept = table.where("day = 1 AND id = '4' AND sex = 'F' AND age > 1")
    execution = kept._jdf.queryExecution()
    plan = execution.executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "EqualTo(id,4)" in plan
    optimized = execution.optimizedPlan().toString()
    assert optimized.count("older") == 1 and "CollectMetrics" not in optimized
    assert [(r.id, r.age, r.day) for r in kept.collect()] == [("4", 44.0, 1)]

    pruned = table.where("id > '2'").select("age")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,age:string>" in pruned
    assert table.count() == 9 and {r.sex for r in table.select("sex").collect()} == {"F", "unknown"}


def test_more_fields_than_one_projection_holds(spark):
    """Finished fields of one projection pass the next ones; rows without any value stay rows."""
    kinds = {"a": "age", "s": "sex", "d": "diagnosis", "b": "braak", "c": "cerad", "p": "apoe", "f": "float", "t": "text"}
    rows = [("94", "m", "AD", "IV", "sparse", "34", "7,2", " x  y "), (None,) * 8]
    frame = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in kinds))
    out = frame.transform(N.normalize_columns(kinds))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [
            (90.0, True, "M", "AD", 4, 1, "E3/E4", 7.2, "x y"),
            (None, False, "unknown", "UNKNOWN", None, None, None, None, None),
        ],
        key=str,
    )
    assert [r.p for r in out.where("a > 1 AND a_censored AND p = 'E3/E4' AND f > 7").collect()] == ["E3/E4"]
    assert out.where("a IS NULL").count() == 1 and out.unionByName(out).join(out, "t").count() == 2

"""Random cells through the Spark normalizers and through their definitions in DuckDB SQL."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cohortloom.functions import normalizers as N
from cohortloom.functions.text import BLANK_TOKENS, is_blank
from cohortloom.plans import checks

SPACES = [" ", "  ", "\t", "\n", "\r\n", "\xa0", "\x1c", " "]
DIGITS = ["0", "1", "2", "3", "4", "7", "34", "89", "90", "91", "120", "3.5", "0.5", ".", ","]
MARKS = ["-", "--", "+", ">", "/", "&", "'", "’", "(", ")", "_", ";", "é", "≥"]
WORDS = {
    "sex": [*N.MALE_TOKENS, *N.FEMALE_TOKENS, "Male", "FEMALE", "male.", "X."],
    "diagnosis": [
        *(t for tokens in N.DIAGNOSIS_TOKENS.values() for t in tokens),
        *(p for _, phrases in N.DIAGNOSIS_PHRASES for p in phrases),
        *N.DIAGNOSIS_QUALIFIERS,
        "Alzheimer's",
        "DEMENTIA",
        "non",
    ],
    "age": ["years", "yrs", "y/o", "yo", "or", "OR", "older", "above", "more", "90+", ">89", "adult", "90 or older"],
    "braak": ["Braak", "stage", "NFT", "score", *N.ROMAN_STAGES, "III", "to", "or", "IV-V", "B2", "stages", "not"],
    "cerad": ["CERAD", "score", "plaque", "plaques", "neuritic", *N.CERAD_LABELS, "None", "C3", "no"],
    "apoe": ["E2", "e3", "E4", "apoe", "/", "33", "carrier"],
    "float": ["hours", "hrs", "h", "hr", "min", "1e3"],
    "text": ["cortex", "Region"],
}


def cells(kind: str, seed: int, count: int = 4000) -> list[str]:
    rng = random.Random(f"{kind}{seed}")
    pools = [WORDS[kind], WORDS[kind], SPACES, DIGITS, MARKS, list(BLANK_TOKENS)]
    made = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(1, 6))) for _ in range(count)]
    made += [rng.choice(SPACES) + rng.choice(list(BLANK_TOKENS)).upper() + rng.choice(SPACES) for _ in range(50)]
    made += [rng.choice(SPACES) + rng.choice(WORDS[kind]) + rng.choice(["", *SPACES]) for _ in range(50)]
    return made


@pytest.mark.parametrize("kind", WORDS)
def test_engines_agree(spark, kind):
    rows = list(enumerate(cells(kind, 1)))
    frame = spark.createDataFrame(rows, "i int, value string").withColumn("raw", F.col("value"))
    normalized = frame.transform(N.normalize_columns({"value": kind})).withColumn("blank", is_blank(F.col("raw")))
    outputs = [name for name in normalized.columns if name not in ("i", "raw")]
    got = {row.i: tuple(row[name] for name in outputs) for row in normalized.collect()}

    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    extra = f", {checks.age_censored('v')}" if kind == "age" else ""
    sql = f"SELECT i, {checks.BUILDERS[kind]('v')}{extra}, {checks.blank('v')} FROM t"
    want = {row[0]: tuple(row[1:]) for row in con.execute(sql).fetchall()}
    wrong = [(rows[i][1], want[i], got[i]) for i in want if want[i] != got[i]]
    assert not wrong, wrong[:10]
    assert len({value[0] for value in got.values()}) > 1

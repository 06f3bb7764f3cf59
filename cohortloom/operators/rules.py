"""The rule registry. A rule's predicate is a boolean column, true on rows that fail."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.text import one_of, strip
from cohortloom.operators.duplicates import mark_duplicates
from cohortloom.schema import BOUNDS, DEGRADED_RIN, DIAGNOSES, REQUIRED_COLUMNS, YOUNG_AGE


class Severity(str, Enum):
    """REJECT sends a row to quarantine; FLAG keeps it and says so."""

    REJECT = "reject"
    FLAG = "flag"


@dataclass(frozen=True)
class Rule:
    """A named check.

    ``predicate`` builds the failing condition for a given table; it may come out NULL, which means "not a failure".
    ``prepare`` adds the helper columns of a rule that looks beyond its own row.
    """

    name: str
    severity: Severity
    description: str
    predicate: Callable[[DataFrame], Column]
    prepare: Callable[[DataFrame], DataFrame] | None = None

    def fails(self, frame: DataFrame) -> Column:
        return F.coalesce(self.predicate(frame), F.lit(False))


def value_of(frame: DataFrame, name: str) -> Column:
    """A column with NaN read as NULL; Spark would order NaN above every bound."""
    column = F.col(name)
    if isinstance(frame.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(column, F.lit(None))
    return column


def on_columns(*names: str, absent: bool, fails: Callable[..., Column]) -> Callable[[DataFrame], Column]:
    """A condition on the values of some columns, and the answer where one of them is absent."""

    def predicate(frame: DataFrame) -> Column:
        if any(name not in frame.columns for name in names):
            return F.lit(absent)
        return fails(*(value_of(frame, name) for name in names))

    return predicate


def is_lacking(value: Column) -> Column:
    return value.isNull() | (strip(value.cast("string")) == "")


DUPLICATE_FLAG = "__duplicate_sample_id"


def _prepare_duplicates(frame: DataFrame) -> DataFrame:
    return mark_duplicates(frame, flag=DUPLICATE_FLAG) if "sample_id" in frame.columns else frame


def _is_duplicate(frame: DataFrame) -> Column:
    return F.col(DUPLICATE_FLAG) if "sample_id" in frame.columns else F.lit(False)


def _out_of_bounds(rule: str, column: str) -> Rule:
    low, high = BOUNDS[column]
    condition = on_columns(column, absent=False, fails=lambda value: ~value.between(low, high))
    return Rule(rule, Severity.REJECT, f"{column} lies outside {low} to {high}.", condition)


def _flag(rule: str, description: str, *columns: str, absent: bool = False, fails: Callable[..., Column]) -> Rule:
    return Rule(rule, Severity.FLAG, description, on_columns(*columns, absent=absent, fails=fails))


RULES: tuple[Rule, ...] = (
    *(
        Rule(
            f"missing_{column}",
            Severity.REJECT,
            f"{column} is required but null or empty.",
            on_columns(column, absent=True, fails=is_lacking),
        )
        for column in REQUIRED_COLUMNS
    ),
    Rule(
        "duplicate_sample_id",
        Severity.REJECT,
        "The batch holds this sample_id more than once; every copy fails, so row order never picks a winner.",
        _is_duplicate,
        _prepare_duplicates,
    ),
    Rule(
        "diagnosis_not_recognized",
        Severity.REJECT,
        "diagnosis is not a word of the vocabulary.",
        on_columns("diagnosis", absent=True, fails=lambda diagnosis: ~one_of(diagnosis, DIAGNOSES)),
    ),
    _out_of_bounds("age_out_of_range", "age_years"),
    _out_of_bounds("braak_out_of_range", "braak_stage"),
    _out_of_bounds("cerad_out_of_range", "cerad_score"),
    _out_of_bounds("rin_out_of_range", "rin"),
    _out_of_bounds("pmi_out_of_range", "pmi_hours"),
    _flag(
        "ad_without_pathology",
        "AD although the Braak stage is 0 or I.",
        "diagnosis",
        "braak_stage",
        fails=lambda diagnosis, stage: (diagnosis == "AD") & (stage <= 1),
    ),
    _flag(
        "control_with_pathology",
        "Control although the Braak stage is V or VI.",
        "diagnosis",
        "braak_stage",
        fails=lambda diagnosis, stage: (diagnosis == "CONTROL") & (stage >= 5),
    ),
    _flag(
        "degraded_rna",
        f"RIN under {DEGRADED_RIN}: expression values are unsafe.",
        "rin",
        fails=lambda rin: rin < DEGRADED_RIN,
    ),
    _flag(
        "implausibly_young",
        f"age_years under {YOUNG_AGE}: look for a unit error.",
        "age_years",
        fails=lambda age: age < YOUNG_AGE,
    ),
    _flag(
        "missing_age",
        "age_years is null: usable, but not for age adjustment.",
        "age_years",
        absent=True,
        fails=lambda age: age.isNull(),
    ),
)


def rules_named(*names: str) -> tuple[Rule, ...]:
    """A subset of the registry, in registry order."""
    return tuple(rule for rule in RULES if rule.name in names)

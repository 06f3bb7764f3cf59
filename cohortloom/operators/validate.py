"""Rule evaluation, verdicts and routing over a whole batch."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.rules import RULES, Rule, Severity

FLAGS = "quality_flags"
REASON = "quarantine_reason"
REJECTED = "__rejected"


def _mask(rule: Rule) -> str:
    return f"__fails_{rule.name}"


def _joined(rules: list[Rule]) -> Column:
    """Names of the failed rules, alphabetical, ``;`` between them. The sort happens here, not per row."""
    names = [F.when(F.col(_mask(rule)), rule.name) for rule in sorted(rules, key=lambda rule: rule.name)]
    return F.concat_ws(";", *names) if names else F.lit("")


def evaluate(frame: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The table with one boolean column per rule, none of them NULL."""
    prepared = reduce(lambda table, rule: rule.prepare(table) if rule.prepare else table, rules, frame)
    return prepared.select(
        *(F.col(f"`{name}`") for name in frame.columns), *(rule.fails(prepared).alias(_mask(rule)) for rule in rules)
    )


def rule_masks(frame: DataFrame, rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """The kept columns and, under its own name, each rule's verdict per row."""
    masks = (F.col(_mask(rule)).alias(rule.name) for rule in rules)
    return evaluate(frame, rules).select(*keep, *masks)


@dataclass
class ValidationReport:
    """A validated batch. The tables are lazy; the counts run one aggregate when first asked for."""

    verdicts: DataFrame
    columns: tuple[str, ...]
    rules: tuple[Rule, ...]

    @property
    def clean(self) -> DataFrame:
        """Rows without a rejection, with their flags."""
        return self._route(rejected=False)

    @property
    def quarantined(self) -> DataFrame:
        """Rejected rows, with their reasons."""
        return self._route(rejected=True)

    def _route(self, rejected: bool) -> DataFrame:
        extra = REASON if rejected else FLAGS
        kept = self.verdicts.where(F.col(REJECTED) if rejected else ~F.col(REJECTED))
        return kept.select(*(F.col(f"`{name}`") for name in self.columns if name != extra), extra)

    def routed(self) -> DataFrame:
        """Every row once: the given columns, ``is_clean``, and ``detail``, its flags if clean, else its reasons.

        The way to read both tables in one pass; ``clean`` and ``quarantined`` run the input once each.
        """
        detail = F.when(F.col(REJECTED), F.col(REASON)).otherwise(F.col(FLAGS))
        kept = [F.col(f"`{name}`") for name in self.columns if name not in (FLAGS, REASON)]
        return self.verdicts.select(*kept, (~F.col(REJECTED)).alias("is_clean"), detail.alias("detail"))

    def measures(self) -> list[Column]:
        """Aggregates over all rows: size, rejections, failures per rule (flags of rejected rows count too)."""
        return [
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(REJECTED).alias("rows_quarantined"),
            *(F.count_if(_mask(rule)).alias(rule.name) for rule in self.rules),
        ]

    def count_table(self) -> DataFrame:
        """The measures as a one-row table: partial aggregates per task, then one tiny final one."""
        return self.verdicts.agg(*self.measures())

    def rule_count_table(self) -> DataFrame:
        """``(rule, failures)``, a row per rule, also at zero."""
        pairs = F.array(
            *(F.struct(F.lit(rule.name).alias("rule"), F.col(rule.name).alias("failures")) for rule in self.rules)
        )
        return self.count_table().select(F.inline(pairs))

    def pass_rate_table(self) -> DataFrame:
        """One row: total, clean, quarantined, pass_rate (1.0 for an empty batch)."""
        clean = F.col("rows_in") - F.col("rows_quarantined")
        return self.count_table().select(
            F.col("rows_in").alias("total"),
            clean.alias("clean"),
            F.col("rows_quarantined").alias("quarantined"),
            F.when(F.col("rows_in") == 0, F.lit(1.0)).otherwise(clean / F.col("rows_in")).alias("pass_rate"),
        )

    @cached_property
    def counts(self) -> dict[str, int]:
        return self.count_table().first().asDict()

    @property
    def rule_counts(self) -> dict[str, int]:
        return {rule.name: self.counts[rule.name] for rule in self.rules}

    @property
    def total(self) -> int:
        return self.counts["rows_in"]

    @property
    def pass_rate(self) -> float:
        return pass_rate(self.counts["rows_in"], self.counts["rows_quarantined"])

    def summary(self) -> str:
        return summarize(self.counts["rows_in"], self.counts["rows_quarantined"], self.rule_counts)


def pass_rate(total: int, quarantined: int) -> float:
    return (total - quarantined) / total if total else 1.0


def summarize(total: int, quarantined: int, rule_counts: dict[str, int]) -> str:
    """One line for logs and alerts. Fixed value: its wording."""
    triggered = {name: count for name, count in rule_counts.items() if count}
    return (
        f"{total - quarantined}/{total} records passed ({pass_rate(total, quarantined):.1%}); "
        f"{quarantined} quarantined; rules triggered: {triggered or 'none'}"
    )


def validate(frame: DataFrame, rules: tuple[Rule, ...] = RULES) -> ValidationReport:
    """Judge every row by the given rules.

    Row rules are one projection. The duplicate rule is the only one that looks across rows, see
    :mod:`cohortloom.operators.duplicates`; with it, this call runs the input once to count ids, so an input that is
    costly to make should be written first, as ``run_all`` does. Everything else runs when the report's tables are read.
    """
    rejecting = [rule for rule in rules if rule.severity is Severity.REJECT]
    flagging = [rule for rule in rules if rule.severity is Severity.FLAG]
    rejected = reduce(or_, [F.col(_mask(rule)) for rule in rejecting], F.lit(False))
    verdicts = evaluate(frame, rules).select(
        "*", rejected.alias(REJECTED), _joined(flagging).alias(FLAGS), _joined(rejecting).alias(REASON)
    )
    return ValidationReport(verdicts, tuple(frame.columns), rules)

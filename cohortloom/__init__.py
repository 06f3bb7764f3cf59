"""Harmonize sample metadata of disagreeing cohorts into one validated table, on Spark."""

from cohortloom.functions.normalizers import normalize_columns
from cohortloom.operators.audit import audit_deliveries, audit_mapping, uncovered_studies
from cohortloom.operators.crosswalk import MAPPINGS, SourceMapping, get_mapping, harmonize, harmonize_many
from cohortloom.operators.rules import RULES, Rule, Severity
from cohortloom.operators.validate import ValidationReport, validate
from cohortloom.plans.run import QualityGateError, RunManifest, enforce_gate, run_all, run_study
from cohortloom.sources.lake import Lake

__all__ = [
    "MAPPINGS",
    "RULES",
    "Lake",
    "QualityGateError",
    "Rule",
    "RunManifest",
    "Severity",
    "SourceMapping",
    "ValidationReport",
    "audit_deliveries",
    "audit_mapping",
    "enforce_gate",
    "get_mapping",
    "harmonize",
    "harmonize_many",
    "normalize_columns",
    "run_all",
    "run_study",
    "uncovered_studies",
    "validate",
]

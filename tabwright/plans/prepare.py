"""From a source file to a trusted cleaned table."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation

from tabwright.operators.clean import (
    CleaningReport,
    CleaningSpec,
    clean_table,
    intake_counts,
    report_from_observation,
)
from tabwright.operators.validate import ValidationReport, ValidationRules, validate_table
from tabwright.sources.files import protect_outputs, qualified
from tabwright.sources.tables import read_table, write_table
from tabwright.sources.zones import ingest


def validate_path(spark, path: str, rules: ValidationRules, **reading) -> ValidationReport:
    """Validate a stored table."""
    return validate_table(read_table(spark, path, **reading), rules)


def clean_path(spark, source: str, destination: str, spec: CleaningSpec, *, overwrite=False, **reading):
    """Clean a stored table into ``destination``; returns the report.

    One pruned aggregate counts the intake; everything else is observed in the
    tasks that write the result.
    """
    if qualified(spark, source) == qualified(spark, destination):
        raise ValueError("the cleaned table must not replace its source")
    protect_outputs(spark, [destination], [source], overwrite)
    table = read_table(spark, source, **reading)
    intake = intake_counts(table, spec).first()
    seen = Observation("cleaning")
    write_table(clean_table(table, spec, seen), destination, overwrite=overwrite)
    return report_from_observation(table, spec, intake, seen.get)


@dataclass(frozen=True)
class Preparation:
    raw_path: str
    cleaned_path: str
    raw_report: ValidationReport
    cleaning: CleaningReport
    cleaned_report: ValidationReport


def prepare_path(
    spark,
    source: str,
    raw_dir: str,
    cleaned_path: str,
    rules: ValidationRules,
    cleaning: CleaningSpec,
    *,
    overwrite: bool = False,
    repeats_are_fatal: bool = False,
    before: ValidationRules | None = None,
    **reading,
) -> Preparation:
    """Ingest, validate raw, clean, validate cleaned.

    Names are not normalised before cleaning, so the raw check covers missing
    fractions and repeats only; target and required columns are checked
    afterwards. ``before`` states other rules for the raw check, target and required
    columns included. ``repeats_are_fatal`` applies to the second check.
    """
    raw_path, raw = ingest(spark, source, raw_dir, overwrite=overwrite, **reading)
    raw_report = validate_table(raw, raw_rules(rules) if before is None else before)
    report = clean_path(spark, raw_path, cleaned_path, cleaning, overwrite=overwrite, **reading)
    cleaned = read_table(spark, cleaned_path)
    final = validate_table(cleaned, replace(rules, fail_on_duplicate_rows=repeats_are_fatal))
    return Preparation(raw_path, cleaned_path, raw_report, report, final)


def raw_rules(rules: ValidationRules) -> ValidationRules:
    return ValidationRules(
        max_missing_fraction=rules.max_missing_fraction,
        fail_on_duplicate_rows=rules.fail_on_duplicate_rows,
    )


def prepare_table(df: DataFrame, rules: ValidationRules, cleaning: CleaningSpec) -> DataFrame:
    """The same flow on a table in hand: both checks raise, the result is lazy."""
    validate_table(df, raw_rules(rules))
    cleaned = clean_table(df, cleaning)
    validate_table(cleaned, rules)
    return cleaned

"""Table validation: every rule is evaluated, every broken rule is reported."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.errors import ValidationFailure
from tabwright.functions import strip_text
from tabwright.operators.counts import as_text, is_missing, missing_counts
from tabwright.operators.duplicates import duplicate_count
from tabwright.operators.schema import header_problems, repeated_names
from tabwright.session import small_table

FINDINGS = "severity string, rule string, column string, value string"
# Unexpected labels named in an error text; the findings table holds all.
LABELS_IN_TEXT = 50


@dataclass(frozen=True)
class ValidationRules:
    required_columns: tuple = ()
    target_column: str | None = None
    allowed_target_values: tuple = ()
    max_missing_fraction: float = 1.0
    fail_on_duplicate_rows: bool = False

    def __post_init__(self):
        if not 0.0 <= self.max_missing_fraction <= 1.0:
            raise ValueError("max_missing_fraction must lie between 0 and 1")


@dataclass(frozen=True)
class ValidationReport:
    rows: int
    columns: int
    duplicate_rows: int
    missing_values: dict = field(default_factory=dict)
    warnings: tuple = ()

    def summary(self) -> str:
        gaps = {c: n for c, n in self.missing_values.items() if n}
        lines = [
            f"table is valid: {self.rows} rows, {self.columns} columns",
            f"repeated rows: {self.duplicate_rows}",
            f"missing values: {gaps or 'none'}",
        ]
        return "\n".join(lines + [f"warning: {w}" for w in self.warnings])


def missing_over(df: DataFrame, max_fraction: float) -> DataFrame:
    """(column, fraction) strictly above ``max_fraction``, rounded to 4 digits."""
    return (
        missing_counts(df)
        .filter(F.col("fraction") > max_fraction)
        .select("column", F.round("fraction", 4).alias("fraction"))
    )


def unexpected_labels(df: DataFrame, target: str, allowed) -> DataFrame:
    """(value) stripped target values outside ``allowed``; missing is ignored."""
    field_ = {f.name: f for f in df.schema.fields}[target]
    wanted = sorted({str(v).strip() for v in allowed})
    return (
        df.filter(~is_missing(field_))
        .select(strip_text(as_text(field_)).alias("value"))
        .filter(~F.col("value").isin(wanted))
        .distinct()
    )


def validation_findings(df: DataFrame, rules: ValidationRules) -> DataFrame:
    """Broken rules as rows (severity, rule, column, value).

    One aggregate covers rows, missing counts, missing fractions and the target;
    repeated rows and unexpected labels each need their own grouping.
    """
    spark = df.sparkSession
    names = df.columns
    static = [("error", rule, detail, "") for rule, detail in header_problems(names, rules.required_columns)]
    if rules.target_column is not None and rules.target_column not in names:
        static.append(("error", "target_absent", rules.target_column, ""))
    found = small_table(spark, static, FINDINGS)
    if not names:
        return found.unionByName(
            small_table(spark, [("error", "no_rows", "", "")], FINDINGS)
        )

    found = found.unionByName(_counted_findings(df, rules))
    severity = "error" if rules.fail_on_duplicate_rows else "warning"
    found = found.unionByName(
        duplicate_count(df)
        .filter("duplicate_rows > 0")
        .select(*_finding(severity, "duplicate_rows", F.lit(""), F.col("duplicate_rows").cast("string")))
    )
    target = rules.target_column
    if names.count(target) == 1 and rules.allowed_target_values:
        found = found.unionByName(
            unexpected_labels(df, target, rules.allowed_target_values).select(
                *_finding("error", "unexpected_label", F.lit(target), F.col("value"))
            )
        )
    return found


def _counted_findings(df: DataFrame, rules: ValidationRules) -> DataFrame:
    """Findings that follow from one aggregate of row and missing counts."""
    names = df.columns
    table = df.toDF(*[f"c{i}" for i in range(len(names))])
    one = table.agg(
        F.count("*").alias("rows"),
        *[F.count_if(is_missing(f)).alias(f"m{i}") for i, f in enumerate(table.schema.fields)],
    )
    cells = [F.when(F.col("rows") == 0, F.struct(*_finding("error", "no_rows", F.lit(""), F.lit(""))))]
    for i, name in enumerate(names):
        missing = F.col(f"m{i}")
        share = F.try_divide(missing, F.col("rows"))
        if not repeated_names(names):
            value = F.round(share, 4).cast("string")
            cells.append(
                F.when(
                    share > rules.max_missing_fraction,
                    F.struct(*_finding("error", "missing_fraction", F.lit(name), value)),
                )
            )
        if name == rules.target_column and names.count(name) == 1:
            cells.append(
                F.when(
                    missing > 0,
                    F.struct(*_finding("error", "missing_target", F.lit(name), missing.cast("string"))),
                )
            )
    return one.select(F.inline(F.array_compact(F.array(*cells))))


def _finding(severity, rule, column, value):
    return [
        F.lit(severity).alias("severity"),
        F.lit(rule).alias("rule"),
        column.alias("column"),
        value.alias("value"),
    ]


def validate_table(df: DataFrame, rules: ValidationRules) -> ValidationReport:
    """Report of a valid table; raises :class:`ValidationFailure` otherwise."""
    names = df.columns
    errors, warnings = [], []
    texts = {
        "no_columns": "the table has no columns",
        "duplicate_column": "column name {!r} is used more than once",
        "blank_column": "column {} has a blank name",
        "required_column": "required column {!r} is absent",
    }
    for rule, detail in header_problems(names, rules.required_columns):
        errors.append(texts[rule].format(detail))
    positional = df.toDF(*[f"c{i}" for i in range(len(names))])
    gaps = [(r["rows"], r["missing"], r["fraction"]) for r in missing_counts(positional).collect()]
    rows = gaps[0][0] if gaps else 0
    if rows == 0:
        errors.append("the table has no rows")
    missing = {name: g[1] for name, g in zip(names, gaps)}
    if rows and not repeated_names(names):
        over = {
            name: round(g[2], 4) for name, g in zip(names, gaps) if g[2] > rules.max_missing_fraction
        }
        if over:
            errors.append(f"more than {rules.max_missing_fraction} of the values are missing: {over}")
    repeats = duplicate_count(df).first()["duplicate_rows"]
    if repeats:
        (errors if rules.fail_on_duplicate_rows else warnings).append(f"{repeats} rows are repeated")
    target = rules.target_column
    if target is not None and target not in names:
        errors.append(f"the target column {target!r} is absent")
    elif target is not None and names.count(target) == 1:
        if missing[target]:
            errors.append(f"the target {target!r} has {missing[target]} missing values")
        if rules.allowed_target_values:
            labels = unexpected_labels(df, target, rules.allowed_target_values)
            shown = [r["value"] for r in labels.sort("value").limit(LABELS_IN_TEXT + 1).collect()]
            if len(shown) > LABELS_IN_TEXT:
                shown = [*shown[:LABELS_IN_TEXT], f"... {labels.count()} labels in all"]
            if shown:
                errors.append(f"the target {target!r} holds unexpected labels: {shown}")
    if errors:
        raise ValidationFailure(errors)
    return ValidationReport(rows, len(names), repeats, missing, tuple(warnings))

"""Cleaning: names, text, empty rows, repeats, numbers, dates - in that order.

Repeats are removed before numbers are parsed, so ``$1,000`` and ``1000`` are
still different rows at that point.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions import (
    DEFAULT_DATE_FORMATS,
    MISSING_MARKERS,
    blank_to_null,
    drop_currency_marks,
    parse_timestamp,
    to_number,
)
from tabwright.operators.counts import is_missing, missing_counts
from tabwright.operators.duplicates import distinct_rows
from tabwright.operators.schema import (
    normalize_columns,
    nulls_only,
    quoted,
    require_columns,
)


@dataclass(frozen=True)
class CleaningSpec:
    numeric_columns: tuple = ()
    date_columns: tuple = ()
    missing_markers: tuple = MISSING_MARKERS
    drop_empty_rows: bool = True
    drop_duplicate_rows: bool = True
    # True: look for repeats by row hash first, so only they are shuffled
    rare_duplicates: bool = False
    date_formats: tuple = DEFAULT_DATE_FORMATS


@dataclass(frozen=True)
class CleaningReport:
    input_rows: int
    output_rows: int
    empty_rows_removed: int
    duplicate_rows_removed: int
    renamed_columns: dict = field(default_factory=dict)
    invalid_numbers: dict = field(default_factory=dict)
    invalid_dates: dict = field(default_factory=dict)
    missing_values: dict = field(default_factory=dict)

    def summary(self) -> str:
        gaps = {c: n for c, n in self.missing_values.items() if n}
        lines = [
            f"rows {self.input_rows} -> {self.output_rows}",
            f"removed: {self.empty_rows_removed} empty, {self.duplicate_rows_removed} repeated",
            f"renamed columns: {self.renamed_columns or 'none'}",
            f"unreadable numbers: {self.invalid_numbers or 'none'}",
            f"unreadable dates: {self.invalid_dates or 'none'}",
            f"missing values: {gaps or 'none'}",
        ]
        return "\n".join(lines)


def clean_text(df: DataFrame, markers=MISSING_MARKERS) -> DataFrame:
    """Strip every text column; missing markers become NULL."""
    return df.select(
        *[
            (
                blank_to_null(quoted(f.name), markers)
                if isinstance(f.dataType, T.StringType)
                else quoted(f.name)
            ).alias(f.name)
            for f in df.schema.fields
        ]
    )


def all_missing(df: DataFrame):
    """True for rows without a single value."""
    test = F.lit(True)
    for f in df.schema.fields:
        test = test & is_missing(f)
    return test


def any_missing(df: DataFrame):
    test = F.lit(False)
    for f in df.schema.fields:
        test = test | is_missing(f)
    return test


def drop_empty(df: DataFrame) -> DataFrame:
    return df.filter(~all_missing(df))


def drop_repeats(df: DataFrame) -> DataFrame:
    """One row per distinct row; the copies are identical, so any survives.

    Grouping on all columns combines copies in the map tasks before the shuffle.
    """
    return df.dropDuplicates()


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without any missing value."""
    return df.filter(~any_missing(df))


def incomplete_rows(df: DataFrame) -> DataFrame:
    """Rows with at least one missing value."""
    return df.filter(any_missing(df))


def _number(f: T.StructField):
    c = quoted(f.name)
    if isinstance(f.dataType, T.StringType):
        c = drop_currency_marks(c)
    return to_number(c, f.dataType)


def convert_numbers(df: DataFrame, columns) -> DataFrame:
    """Named columns as numbers; text loses separators and currency signs first."""
    require_columns(df, columns, "number conversion")
    fields = {f.name: f for f in df.schema.fields}
    return df.withColumns({c: _number(fields[c]) for c in columns}) if columns else df


def convert_dates(df: DataFrame, columns, formats=DEFAULT_DATE_FORMATS) -> DataFrame:
    """Named columns as timestamps; unparseable values become NULL."""
    require_columns(df, columns, "date conversion")
    fields = {f.name: f for f in df.schema.fields}
    if not columns:
        return df
    return df.withColumns(
        {c: parse_timestamp(quoted(c), fields[c].dataType, formats) for c in columns}
    )


def invalid_counters(df: DataFrame, spec: CleaningSpec) -> list:
    """(kind, column, counter) for values that are present but not convertible."""
    fields = {f.name: f for f in df.schema.fields}
    counters = []
    for c in spec.numeric_columns:
        lost = ~is_missing(fields[c]) & _number(fields[c]).isNull()
        counters.append(("number", c, F.count_if(lost)))
    for c in spec.date_columns:
        parsed = parse_timestamp(quoted(c), fields[c].dataType, spec.date_formats)
        lost = ~is_missing(fields[c]) & parsed.isNull()
        counters.append(("date", c, F.count_if(lost)))
    return counters


def trimmed_rows(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Cleaning up to and including the removal of repeats."""
    named, _ = normalize_columns(df)
    text = clean_text(nulls_only(named), spec.missing_markers)
    if spec.drop_empty_rows:
        text = drop_empty(text)
    if not spec.drop_duplicate_rows:
        return text
    return distinct_rows(text) if spec.rare_duplicates else drop_repeats(text)


def clean_table(df: DataFrame, spec: CleaningSpec, observation: Observation | None = None):
    """The cleaned table, lazily.

    ``observation`` counts unreadable values, missing values and output rows
    above the last shuffle, in the tasks that write the result, where a task
    that runs twice is still counted once.
    """
    rows = trimmed_rows(df, spec)
    require_columns(rows, spec.numeric_columns, "number conversion")
    require_columns(rows, spec.date_columns, "date conversion")
    fields = rows.schema.fields
    if observation is None:
        return rows.select(*[_converted(f, spec).alias(f.name) for f in fields])
    names = {f.name: f for f in fields}
    kinds = [*spec.numeric_columns, *spec.date_columns]
    lost = [~is_missing(names[c]) & _converted(names[c], spec).isNull() for c in kinds]
    # values and flags are computed once below the observation
    staged = rows.select(
        *[_converted(f, spec).alias(f.name) for f in fields],
        *[flag.alias(f"lost_{n}_") for n, flag in enumerate(lost)],
    ).observe(
        observation,
        F.count("*").alias("rows"),
        *[F.count_if(F.col(f"lost_{n}_")).alias(f"i{n}") for n in range(len(kinds))],
        *[F.count_if(quoted(f.name).isNull()).alias(f"m{n}") for n, f in enumerate(fields)],
    )
    return staged.select(*[quoted(f.name) for f in fields])


def _converted(f: T.StructField, spec: CleaningSpec):
    """The column as number or timestamp when the spec names it."""
    if f.name in spec.numeric_columns:
        return _number(f)
    if f.name in spec.date_columns:
        return parse_timestamp(quoted(f.name), f.dataType, spec.date_formats)
    return quoted(f.name)


def invalid_counts(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """(kind, column, invalid) for the columns to convert, repeats removed first."""
    rows = trimmed_rows(df, spec)
    counters = invalid_counters(rows, spec)
    one = rows.agg(
        F.count("*").alias("rows"), *[c.alias(f"i{n}") for n, (_, _, c) in enumerate(counters)]
    )
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(kind).alias("kind"),
                        F.lit(column).alias("column"),
                        F.col(f"i{n}").alias("invalid"),
                    )
                    for n, (kind, column, _) in enumerate(counters)
                ]
            )
        )
    )


def intake_counts(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """One row (input_rows, empty_rows) of the table before cleaning."""
    named, _ = normalize_columns(df)
    text = clean_text(nulls_only(named), spec.missing_markers)
    empty = F.count_if(all_missing(text)) if spec.drop_empty_rows else F.lit(0).cast("bigint")
    return text.agg(F.count("*").alias("input_rows"), empty.alias("empty_rows"))


def row_accounting(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """One row: input_rows, empty_rows_removed, duplicate_rows_removed, output_rows."""
    intake = intake_counts(df, spec)
    kept = trimmed_rows(df, spec).agg(F.count("*").alias("output_rows"))
    both = intake.withColumn("one", F.lit(1)).join(kept.withColumn("one", F.lit(1)), "one")
    return both.select(
        "input_rows",
        F.col("empty_rows").alias("empty_rows_removed"),
        (F.col("input_rows") - F.col("empty_rows") - F.col("output_rows")).alias(
            "duplicate_rows_removed"
        ),
        "output_rows",
    )


def report_from_observation(df, spec: CleaningSpec, intake, seen: dict) -> CleaningReport:
    """Build the report after a write that carried ``clean_table``'s observation."""
    named, renamed = normalize_columns(df)
    kinds = [("number", c) for c in spec.numeric_columns] + [("date", c) for c in spec.date_columns]
    lost = {"number": {}, "date": {}}
    for n, (kind, column) in enumerate(kinds):
        if seen[f"i{n}"]:
            lost[kind][column] = seen[f"i{n}"]
    return CleaningReport(
        input_rows=intake["input_rows"],
        output_rows=seen["rows"],
        empty_rows_removed=intake["empty_rows"],
        duplicate_rows_removed=intake["input_rows"] - intake["empty_rows"] - seen["rows"],
        renamed_columns=renamed,
        invalid_numbers=lost["number"],
        invalid_dates=lost["date"],
        missing_values={c: seen[f"m{n}"] for n, c in enumerate(named.columns)},
    )


def clean_with_report(df: DataFrame, spec: CleaningSpec):
    """(cleaned table, report) without writing: two pruned aggregates."""
    _, renamed = normalize_columns(df)
    cleaned = clean_table(df, spec)
    counts = row_accounting(df, spec).first()
    lost = {"number": {}, "date": {}}
    if spec.numeric_columns or spec.date_columns:
        for r in invalid_counts(df, spec).collect():
            if r["invalid"]:
                lost[r["kind"]][r["column"]] = r["invalid"]
    gaps = {r["column"]: r["missing"] for r in missing_counts(cleaned).collect()}
    return cleaned, CleaningReport(
        input_rows=counts["input_rows"],
        output_rows=counts["output_rows"],
        empty_rows_removed=counts["empty_rows_removed"],
        duplicate_rows_removed=counts["duplicate_rows_removed"],
        renamed_columns=renamed,
        invalid_numbers=lost["number"],
        invalid_dates=lost["date"],
        missing_values=gaps,
    )

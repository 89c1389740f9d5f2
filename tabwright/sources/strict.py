"""Strict scoring input: every broken rule is found and shown by example."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.errors import StrictInputError
from tabwright.functions import is_infinite, normalize_column_name, to_number
from tabwright.functions.text import strip_text
from tabwright.operators.clean import all_missing
from tabwright.operators.counts import as_text, is_missing
from tabwright.operators.rownum import number_rows, number_scan_rows
from tabwright.operators.schema import quoted, repeated_names
from tabwright.session import small_table
from tabwright.sources.files import size_in_bytes
from tabwright.sources.tables import raw_csv, typed, infer_types

VIOLATIONS = "rule string, column string, row_key string, value string"


@dataclass(frozen=True)
class StrictSpec:
    """What a scoring input must look like. Limits apply only when given."""

    required_columns: tuple = ()
    numeric_columns: tuple = ()
    text_columns: tuple = ()
    nonnegative_columns: tuple = ()
    target_column: str | None = None
    key_column: str | None = None
    key_prefix: str = "UPLOAD-"
    key_digits: int = 5
    max_bytes: int | None = None
    max_columns: int | None = None
    max_rows: int | None = None
    examples: int = 5
    empty_examples: int = 10


def checked_header(names, max_columns=None) -> list:
    """Normalised names of a header; blank and colliding names are errors."""
    if max_columns is not None and len(names) > max_columns:
        raise StrictInputError(f"{len(names)} columns are more than the limit of {max_columns}")
    renamed = [normalize_column_name(n or "") for n in names]
    blank = [i + 1 for i, n in enumerate(renamed) if not n]
    if blank:
        raise StrictInputError(f"blank column names at positions {blank}")
    clashes = repeated_names(renamed)
    if clashes:
        raise StrictInputError(f"several columns are named {clashes}")
    return renamed


def with_generated_key(df: DataFrame, spec: StrictSpec, order_by=()) -> DataFrame:
    """Add the key column as prefix and a zero-padded row number from 1.

    Without ``order_by`` rows of a table read from files are numbered in file order.
    """
    if order_by:
        numbered = number_rows(df, "key_number_", 1, order_by)
    else:
        numbered = number_scan_rows(df, "key_number_", 1)
    digits = F.col("key_number_").cast("string")
    padded = F.when(
        F.length(digits) < spec.key_digits, F.lpad(digits, spec.key_digits, "0")
    ).otherwise(digits)
    return numbered.select(
        *[quoted(c) for c in df.columns],
        F.concat(F.lit(spec.key_prefix), padded).alias(spec.key_column),
    )


def violations(df: DataFrame, spec: StrictSpec, row_key: str, *, every: bool = False) -> DataFrame:
    """(rule, column, row_key, value) for rows that break a rule.

    Rules: ``empty_row``, ``not_a_number``, ``infinite``, ``negative``. Each
    row yields its violations in one pass without a shuffle; unless ``every``,
    the first few per rule and column in key order are kept, a limit that is
    pushed into the map tasks.
    """
    fields = {f.name: f for f in df.schema.fields}
    key = quoted(row_key).cast("string")
    cells = []
    values = df.drop(row_key)

    def cell(test, rule, column, value):
        return F.when(
            test,
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(column).alias("column"),
                key.alias("row_key"),
                value.alias("value"),
                quoted(row_key).alias("order_"),
            ),
        )

    cells.append(cell(all_missing(values), "empty_row", "", F.lit(None).cast("string")))
    for c in sorted(set(spec.numeric_columns) & set(df.columns)):
        f = fields[c]
        number = to_number(quoted(c), f.dataType)
        text = as_text(f)
        cells.append(cell(~is_missing(f) & number.isNull(), "not_a_number", c, text))
        cells.append(cell(is_infinite(number.cast("double")), "infinite", c, text))
        if c in spec.nonnegative_columns:
            cells.append(cell(number < 0, "negative", c, text))
    found = df.select(F.inline(F.array_compact(F.array(*cells))))
    if every:
        return found.drop("order_")
    order = Window.partitionBy("rule", "column").orderBy("order_")
    most = F.when(F.col("rule") == "empty_row", spec.empty_examples).otherwise(spec.examples)
    limit = max(spec.examples, spec.empty_examples)
    return (
        found.withColumn("place_", F.row_number().over(order))
        .filter(F.col("place_") <= limit)
        .filter(F.col("place_") <= most)
        .drop("order_", "place_")
    )


def violation_counts(df: DataFrame, spec: StrictSpec, row_key: str) -> DataFrame:
    """(rule, column, rows) of all violations."""
    return violations(df, spec, row_key, every=True).groupBy("rule", "column").agg(
        F.count("*").alias("rows")
    )


def as_scoring_input(df: DataFrame, spec: StrictSpec) -> DataFrame:
    """Numbers typed, text and key columns stripped with blanks as NULL."""
    fields = {f.name: f for f in df.schema.fields}
    changed = {}
    for c in df.columns:
        if c in spec.numeric_columns:
            changed[c] = to_number(quoted(c), fields[c].dataType)
        elif c in spec.text_columns or c == spec.key_column:
            text = strip_text(as_text(fields[c]))
            changed[c] = F.when(text != "", text)
    return df.withColumns(changed) if changed else df


def read_strict_csv(spark, path: str, spec: StrictSpec, *, multiline: bool = False):
    """(table, warnings) of a CSV that meets ``spec``; else StrictInputError
    naming every broken rule with example line numbers (header = line 1)."""
    if spec.max_bytes is not None and size_in_bytes(spark, path) > spec.max_bytes:
        raise StrictInputError(f"the file is larger than {spec.max_bytes} bytes")
    head = spark.read.csv(path, header=False, quote='"', escape='"', multiLine=multiline).take(1)
    if not head:
        raise StrictInputError("the file is empty")
    names = checked_header(list(head[0]), spec.max_columns)
    table = raw_csv(spark, path, multiline=multiline).toDF(*names)
    warnings = []
    if spec.target_column in names:
        warnings.append(f"target column {spec.target_column} was left out")
    kept = [c for c in names if c != spec.target_column]
    numbered = number_scan_rows(table, "line_", 2)
    rows = numbered.count()
    if rows == 0:
        raise StrictInputError("the file holds no data rows")
    if spec.max_rows is not None and rows > spec.max_rows:
        raise StrictInputError(f"{rows} rows are more than the limit of {spec.max_rows}")

    absent = sorted(set(spec.required_columns) - set(kept))
    make_key = spec.key_column is not None and absent == [spec.key_column]
    if absent and not make_key:
        raise StrictInputError(f"required columns are absent: {absent}")
    extra = sorted(set(kept) - set(spec.required_columns))
    if extra:
        warnings.append(f"columns without a use are kept: {extra}")

    shown = violations(numbered, spec, "line_").collect()
    if shown:
        groups = {}
        for r in sorted(shown, key=lambda r: (r["rule"], r["column"], int(r["row_key"]))):
            entry = r["row_key"] if r["value"] is None else f"{r['row_key']}: {r['value']!r}"
            groups.setdefault((r["rule"], r["column"]), []).append(entry)
        raise StrictInputError(
            "; ".join(f"{rule} {column} at lines {where}" for (rule, column), where in groups.items())
        )
    free = [c for c in kept if c not in spec.numeric_columns and c not in spec.text_columns]
    kinds = infer_types(numbered.select(*[quoted(c) for c in free])) if free else {}
    result = numbered.select(
        *[
            (typed(quoted(c), kinds[c]) if c in kinds and c != spec.key_column else quoted(c)).alias(c)
            for c in kept
        ],
        "line_",
    )
    if make_key:
        digits = (F.col("line_") - 1).cast("string")
        padded = F.when(
            F.length(digits) < spec.key_digits, F.lpad(digits, spec.key_digits, "0")
        ).otherwise(digits)
        result = result.withColumn(spec.key_column, F.concat(F.lit(spec.key_prefix), padded))
        warnings.append(f"{spec.key_column} was generated for every row")
    return as_scoring_input(result.drop("line_"), spec), tuple(warnings)


def input_template(spark, columns) -> DataFrame:
    """An empty table with the required columns in order."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return small_table(spark, [], schema)

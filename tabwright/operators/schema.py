"""Column names and column roles. Driver-side: nothing here reads rows."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions import nan_to_null, normalize_column_name
from tabwright.session import small_table

FLOATING = (T.DoubleType, T.FloatType)


def quoted(name: str):
    """Column reference that is safe for names holding dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def require_columns(df: DataFrame, wanted, purpose: str) -> None:
    absent = sorted(set(wanted) - set(df.columns))
    if absent:
        raise ValueError(f"{purpose} needs columns the table does not have: {absent}")


def repeated_names(names) -> list:
    """Names that occur more than once, sorted."""
    return sorted(n for n, k in Counter(names).items() if k > 1)


def header_problems(names, required=()) -> list:
    """(rule, detail) pairs for the name checks that need no data."""
    problems = []
    if not names:
        problems.append(("no_columns", ""))
    problems += [("duplicate_column", n) for n in repeated_names(names)]
    problems += [("blank_column", str(i + 1)) for i, n in enumerate(names) if not n.strip()]
    problems += [("required_column", n) for n in sorted(set(required) - set(names))]
    return problems


def normalized_names(names) -> list:
    """snake_case version of every name; rejects empty and colliding results."""
    renamed = [normalize_column_name(n) for n in names]
    lost = [old for old, new in zip(names, renamed) if not new]
    if lost:
        raise ValueError(f"nothing is left of these column names: {lost}")
    clashes = repeated_names(renamed)
    if clashes:
        raise ValueError(f"several columns would get the same name: {clashes}")
    return renamed


def normalize_columns(df: DataFrame):
    """Rename all columns to snake_case; returns (table, changed names)."""
    new = normalized_names(df.columns)
    changed = {a: b for a, b in zip(df.columns, new) if a != b}
    return (df.toDF(*new) if changed else df), changed


def nulls_only(df: DataFrame) -> DataFrame:
    """Apply the source-boundary rule that missing is NULL, never NaN."""
    if not any(isinstance(f.dataType, FLOATING) for f in df.schema.fields):
        return df
    return df.select(
        *[nan_to_null(quoted(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def _is_number(dtype) -> bool:
    return isinstance(dtype, T.NumericType)


def training_roles(df: DataFrame, target=None):
    """(numeric, categorical) for model fitting: booleans are numeric, all
    other non-number columns, dates too, are categorical."""
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name == target:
            continue
        is_numeric = _is_number(f.dataType) or isinstance(f.dataType, T.BooleanType)
        (numeric if is_numeric else categorical).append(f.name)
    return numeric, categorical


def profile_roles(df: DataFrame, target=None):
    """(numeric, categorical) for profiling: booleans are categorical and
    dates are neither."""
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name == target:
            continue
        if _is_number(f.dataType):
            numeric.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            categorical.append(f.name)
    return numeric, categorical


def roles_table(df: DataFrame, target=None) -> DataFrame:
    """One row per column with its Spark type and both role assignments."""
    train_num, train_cat = training_roles(df, target)
    prof_num, prof_cat = profile_roles(df, target)

    def role(name, num, cat):
        return "numeric" if name in num else "categorical" if name in cat else "other"

    rows = [
        (
            i,
            f.name,
            f.dataType.simpleString(),
            "target" if f.name == target else role(f.name, train_num, train_cat),
            "target" if f.name == target else role(f.name, prof_num, prof_cat),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return small_table(df.sparkSession, 
        rows,
        "position bigint, column string, dtype string, training_role string, "
        "profile_role string",
    )

"""Per-column counts over whole tables.

``value_counts`` is the shared long form: chosen columns become (column, value)
rows and are grouped once. Partial aggregation runs before the shuffle, so a
value that holds a third of all rows arrives as one row per map task. Distinct
counts, modes, domains and top-N lists all derive from that one table instead
of one ``count(distinct)`` per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.schema import FLOATING, quoted, require_columns
from tabwright.session import small_table


def as_text(field: T.StructField):
    """Text form of a value; NaN is missing and -0.0 equals 0.0."""
    c = quoted(field.name)
    if isinstance(field.dataType, FLOATING):
        c = F.when(c == 0, F.lit(0.0).cast(field.dataType)).when(~F.isnan(c), c)
    return c.cast("string")


def long_form(df: DataFrame, columns) -> DataFrame:
    """(column, value) rows of the chosen columns as text."""
    require_columns(df, columns, "long form")
    if len(set(columns)) != len(columns):
        raise ValueError("columns are listed twice")
    fields = {f.name: f for f in df.schema.fields}
    narrow = df.select(*[as_text(fields[c]).alias(c) for c in columns])
    return narrow.unpivot(
        [], [quoted(c) for c in columns], "column", "value"
    )


def value_counts(df: DataFrame, columns) -> DataFrame:
    """(column, value, n); missing values count as value NULL."""
    return long_form(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))


def is_missing(field: T.StructField):
    c = quoted(field.name)
    if isinstance(field.dataType, FLOATING):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, rows, missing, fraction): one scan, one aggregate for all columns."""
    fields = df.schema.fields
    one = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(is_missing(f)).alias(f"m{i}") for i, f in enumerate(fields)],
    )
    if not fields:
        return small_table(df.sparkSession, 
            [], "column string, rows bigint, missing bigint, fraction double"
        )
    pairs = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.col("rows"),
                F.col(f"m{i}").alias("missing"),
                F.try_divide(F.col(f"m{i}"), F.col("rows")).alias("fraction"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return one.select(F.inline(pairs))


def missing_summary(df: DataFrame) -> DataFrame:
    """One row: rows, columns, cells, missing cells and their percentage."""
    per = missing_counts(df)
    total = F.sum("missing")
    cells = F.sum("rows")
    return per.agg(
        F.max("rows").alias("rows"),
        F.count("*").alias("columns"),
        cells.alias("cells"),
        total.alias("missing_cells"),
        (F.try_divide(total, cells) * 100).alias("missing_percent"),
    )


def distinct_counts(df: DataFrame, columns=None) -> DataFrame:
    """(column, n_distinct), missing ignored."""
    columns = list(columns or df.columns)
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(F.count("value").alias("n_distinct"))
    )


def distinct_values(df: DataFrame, columns) -> DataFrame:
    """(column, value) for every value a column holds, missing included."""
    return value_counts(df, columns).select("column", "value")


def modes(counts: DataFrame) -> DataFrame:
    """(column, value) most frequent value, ties to the smallest, from long counts.

    A mergeable ``min`` over (-n, value), so no task holds a column's values.
    """
    return (
        counts.filter(F.col("value").isNotNull())
        .groupBy("column")
        .agg(F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("value"))).alias("best"))
        .select("column", F.col("best.value").alias("value"), (-F.col("best.minus_n")).alias("n"))
    )


def top_categories(counts: DataFrame, limit: int) -> DataFrame:
    """Top ``limit`` values per column and one row with the rest.

    Ties go to the smaller value, missing last. The row-number filter is pushed
    into each map task, so only ``limit`` candidates per column and task are
    shuffled. The remainder row is marked by ``is_other`` because a table may
    hold a real category called Other.
    """
    order = Window.partitionBy("column").orderBy(
        F.col("n").desc(), F.col("value").asc_nulls_last()
    )
    top = (
        counts.withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= limit)
        .select(
            "column",
            F.col("position").cast("bigint").alias("position"),
            "value",
            "n",
            F.lit(False).alias("is_other"),
        )
    )
    totals = counts.groupBy("column").agg(
        F.sum("n").alias("total"), F.count("*").alias("n_values")
    )
    shown = top.groupBy("column").agg(F.sum("n").alias("shown"))
    rest = (
        totals.filter(F.col("n_values") > limit)
        .join(shown, "column")
        .select(
            "column",
            F.lit(limit + 1).cast("bigint").alias("position"),
            F.lit("Other").alias("value"),
            (F.col("total") - F.col("shown")).alias("n"),
            F.lit(True).alias("is_other"),
        )
    )
    return top.unionByName(rest)

"""Profiling tables: the data behind charts and overviews."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions import display_name, shorten_label, to_number
from tabwright.operators.counts import (
    distinct_counts,
    missing_counts,
    top_categories,
    value_counts,
)
from tabwright.operators.gram import blocked_correlations
from tabwright.operators.quantiles import exact_medians, exact_percentiles
from tabwright.operators.schema import profile_roles, quoted, require_columns
from tabwright.session import small_table

#: From this many columns on, correlations come from Gram matrices instead of one expression a sum.
GRAM_COLUMNS = 32


@dataclass(frozen=True)
class ProfileSpec:
    """Limits on the number of profiled columns are off unless given. Categorical columns
    that look like identifiers (by name, or with more than ``identifier_values`` distinct
    values that exceed ``identifier_share`` of the rows, counted exactly) are left out of
    the automatic choice unless ``keep_identifiers``."""

    target_column: str | None = None
    numeric_columns: tuple = ()
    categorical_columns: tuple = ()
    max_numeric_columns: int | None = None
    max_categorical_columns: int | None = None
    max_categories: int = 12
    histogram_bins: int = 30
    keep_identifiers: bool = False
    identifier_values: int = 60
    identifier_share: float = 0.5

    def __post_init__(self):
        limits = (
            self.max_numeric_columns, self.max_categorical_columns,
            self.max_categories, self.histogram_bins,
        )
        if min(n for n in limits if n is not None) < 1:
            raise ValueError("profile limits must be positive")


def numbers(df: DataFrame, columns) -> DataFrame:
    """The named columns as doubles, missing as NULL."""
    require_columns(df, columns, "profiling")
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[to_number(quoted(c), types[c]).cast("double").alias(c) for c in columns])


def identifier_like(name: str) -> bool:
    return name.lower() == "id" or name.lower().endswith("_id")


def wide_categories(df: DataFrame, columns, above: float, share: float = 0.5) -> dict:
    """{column: distinct} for columns with more than ``above`` distinct values
    that also exceed ``share`` of the rows.

    All columns are counted exactly, by one grouping in long form.
    """
    if not columns:
        return {}
    rows = df.count()
    exact = {r["column"]: r["n_distinct"] for r in distinct_counts(df, columns).collect()}
    return {c: exact[c] for c in columns if exact.get(c, 0) > above and exact[c] > share * rows}


def choose_columns(df: DataFrame, spec: ProfileSpec):
    """(numeric, categorical, warnings) to profile."""
    warnings = []
    if spec.target_column is not None:
        require_columns(df, [spec.target_column], "the target profile")
    numeric, categorical = profile_roles(df, spec.target_column)
    if spec.numeric_columns:
        require_columns(df, spec.numeric_columns, "numeric profiles")
        numeric = list(spec.numeric_columns)
    if spec.categorical_columns:
        require_columns(df, spec.categorical_columns, "category profiles")
        categorical = list(spec.categorical_columns)
    elif not spec.keep_identifiers:
        wide = wide_categories(df, categorical, spec.identifier_values, spec.identifier_share)
        skipped = [c for c in categorical if identifier_like(c) or c in wide]
        warnings += [f"{c} looks like an identifier and is not profiled" for c in skipped]
        categorical = [c for c in categorical if c not in skipped]
    for kind, names, most in (
        ("numeric", numeric, spec.max_numeric_columns),
        ("categorical", categorical, spec.max_categorical_columns),
    ):
        if most is not None and len(names) > most:
            warnings.append(f"{len(names)} {kind} columns; the first {most} are profiled")
            del names[most:]
    return numeric, categorical, warnings


def category_profile(df: DataFrame, columns, limit: int) -> DataFrame:
    """(column, position, value, label, n, is_other) top categories per column."""
    top = top_categories(value_counts(df, columns), limit)
    return top.select(
        "column", "position", "value", shorten_label(F.col("value")).alias("label"), "n", "is_other"
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """(column, missing, percent) of columns with gaps, fewest first."""
    return (
        missing_counts(df)
        .filter("missing > 0")
        .select("column", "missing", (F.col("fraction") * 100).alias("percent"))
        .orderBy("missing", "column")
    )


def histogram(df: DataFrame, columns, bins: int = 30) -> DataFrame:
    """(column, bin, low, high, n): equal-width bins, the last one closed.

    One aggregate finds the ranges, a second pass counts in long form with
    partial aggregation; empty bins are included. A constant column gets the
    range value +- 0.5. Infinite values have no bin.
    """
    data = numbers(df, columns)
    big = float("inf")
    finite = {c: F.when(F.abs(quoted(c)) < big, quoted(c)) for c in columns}
    ends = data.agg(
        *[
            f(finite[c]).alias(f"{tag}{i}")
            for i, c in enumerate(columns)
            for tag, f in (("a", F.min), ("b", F.max))
        ]
    ).first()
    ranges, rows = {}, []
    for i, c in enumerate(columns):
        low, high = ends[f"a{i}"], ends[f"b{i}"]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        step = (high - low) / bins
        ranges[c] = (low, high, step)
        edges = [low + k * step for k in range(bins)] + [high]
        rows += [(c, k, edges[k], edges[k + 1]) for k in range(bins)]
    frame = small_table(
        df.sparkSession, rows, "column string, bin bigint, low double, high double"
    )
    if not ranges:
        return frame.withColumn("n", F.lit(0).cast("bigint"))

    def bin_of(c):
        low, high, step = ranges[c]
        x = finite[c]
        guess = F.least(F.floor((x - low) / (high - low) * bins), F.lit(bins - 1))
        # values next to an edge are settled by the edges themselves
        down = (x < F.lit(low) + guess * step).cast("int")
        up = ((x >= F.lit(low) + (guess + 1) * step) & (guess < bins - 1)).cast("int")
        return F.struct(F.lit(c).alias("column"), (guess - down + up).cast("bigint").alias("bin"))

    counted = (
        data.select(F.inline(F.array(*[bin_of(c) for c in ranges])))
        .filter("bin is not null")
        .groupBy("column", "bin")
        .agg(F.count("*").alias("n"))
    )
    return frame.join(counted, ["column", "bin"], "left").select(
        "column", "bin", "low", "high", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def median_table(df: DataFrame, columns, **options) -> DataFrame:
    """(column, median)."""
    rows = list(exact_medians(df, columns, **options).items())
    return small_table(df.sparkSession, rows, "column string, median double")


def correlations(df: DataFrame, columns) -> DataFrame:
    """(left, right, correlation) for every pair, both orders and the diagonal.

    Pearson over rows where both columns have a value; NULL when either is
    constant there. A first aggregate gives each column's mean and gaps, a second
    one sums products of centred values. Columns without gaps share their own
    sums across all pairs. From ``GRAM_COLUMNS`` columns on, ``blocked_correlations`` takes over.
    """
    columns = list(columns)
    if len(columns) >= GRAM_COLUMNS:
        return blocked_correlations(numbers(df, columns), columns)
    data = numbers(df, columns)
    first = data.agg(
        F.count("*").alias("rows"),
        *[
            f(quoted(c)).alias(f"{tag}{i}")
            for i, c in enumerate(columns)
            for tag, f in (("n", F.count), ("mean", F.avg))
        ],
    ).first()
    full = [first[f"n{i}"] == first["rows"] for i in range(len(columns))]
    centred = [quoted(c) - F.lit(first[f"mean{i}"]) for i, c in enumerate(columns)]

    sums, tags = [], {}

    def total(key, expression):
        if key not in tags:
            tags[key] = f"t{len(tags)}"
            sums.append(expression.alias(tags[key]))
        return F.col(tags[key])

    def value(i, j):
        x, y = centred[i], centred[j]
        both = quoted(columns[i]).isNotNull() & quoted(columns[j]).isNotNull()

        def over(k, z, other):
            """n, sum, sum of squares and whether ``z`` varies where ``other`` exists."""
            own = full[other]
            key = (k,) if own else (k, other)
            kept = z if own else F.when(both, z)
            return (
                total((*key, "n"), F.count(kept)),
                total((*key, "s"), F.sum(kept)),
                total((*key, "q"), F.sum(kept * kept)),
                total((*key, "low"), F.min(kept)) < total((*key, "high"), F.max(kept)),
            )

        n, sx, qx, x_varies = over(i, x, j)
        _, sy, qy, y_varies = over(j, y, i)
        cross = total((i, j, "xy"), F.sum(x * y))
        zero = F.lit(0.0)
        spread = F.sqrt(
            F.greatest(qx - sx * sx / n, zero) * F.greatest(qy - sy * sy / n, zero)
        )
        r = F.lit(1.0) if i == j else F.try_divide(cross - sx * sy / n, spread)
        # infinite values leave no defined correlation
        sound = x_varies & y_varies & ~F.isnan(spread)
        return F.when(sound, F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))

    cells = []
    for i, a in enumerate(columns):
        for j in range(i, len(columns)):
            r = value(i, j)
            for left, right in dict.fromkeys([(a, columns[j]), (columns[j], a)]):
                cells.append(
                    F.struct(
                        F.lit(left).alias("left"), F.lit(right).alias("right"), r.alias("correlation")
                    )
                )
    return data.agg(*sums).select(F.inline(F.array(*cells)))


def describe_numbers(df: DataFrame, columns, **options) -> DataFrame:
    """(column, n, mean, std, min, p25, p50, p75, max); percentiles are exact."""
    data = numbers(df, columns)
    found = exact_percentiles(df, columns, [0.25, 0.5, 0.75], **options)

    def fixed(c, k):
        v = found[c][k]
        return F.lit(v).cast("double")

    one = data.agg(
        *[
            f(quoted(c)).alias(f"{tag}{i}")
            for i, c in enumerate(columns)
            for tag, f in (
                ("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max),
            )
        ]
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("n"),
            F.col(f"mean{i}").alias("mean"),
            F.col(f"std{i}").alias("std"),
            F.col(f"min{i}").alias("min"),
            fixed(c, 0).alias("p25"),
            fixed(c, 1).alias("p50"),
            fixed(c, 2).alias("p75"),
            F.col(f"max{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    return one.select(F.inline(F.array(*cells)))


def column_overview(df: DataFrame) -> DataFrame:
    """(position, column, dtype, rows, non_null, missing, percent)."""
    kinds = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    gaps = missing_counts(df)
    shape = small_table(df.sparkSession, kinds, "position bigint, column string, dtype string")
    return shape.join(gaps, "column").select(
        "position",
        "column",
        "dtype",
        "rows",
        (F.col("rows") - F.col("missing")).alias("non_null"),
        "missing",
        (F.col("fraction") * 100).alias("percent"),
    )


def table_shape(df: DataFrame) -> DataFrame:
    """One row (rows, columns)."""
    return df.agg(F.count("*").alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("bigint")
    )


def head_rows(df: DataFrame, order_by, n: int = 5) -> DataFrame:
    """First ``n`` rows in the order of ``order_by`` (a distributed top-n)."""
    require_columns(df, order_by, "ordering")
    return df.orderBy(*[quoted(c) for c in order_by]).limit(n)


def profile_tables(df: DataFrame, spec: ProfileSpec):
    """({name: DataFrame}, warnings): only the tables that apply.

    ``target``, ``missing``, ``histogram``, ``medians``, ``correlation``,
    ``categories`` and ``overview``.
    """
    numeric, categorical, warnings = choose_columns(df, spec)
    overview = column_overview(df)
    tables = {"overview": overview}
    if spec.target_column is not None:
        tables["target"] = category_profile(df, [spec.target_column], spec.max_categories)
    if overview.filter("missing > 0").take(1):
        tables["missing"] = missing_profile(df)
    if numeric:
        tables["histogram"] = histogram(df, numeric, spec.histogram_bins)
        tables["medians"] = median_table(df, numeric)
        if len(numeric) > 1:
            tables["correlation"] = correlations(df, numeric)
    else:
        warnings.append("no numeric columns to profile")
    if categorical:
        tables["categories"] = category_profile(df, categorical, spec.max_categories)
    else:
        warnings.append("no categorical columns to profile")
    return tables, warnings


def overview_record(df: DataFrame, spec: ProfileSpec, source: str = "") -> dict:
    """JSON-ready overview of a table."""
    numeric, categorical, warnings = choose_columns(df, spec)
    rows = column_overview(df).sort("position").collect()
    return {
        "dataset": source,
        "row_count": rows[0]["rows"] if rows else 0,
        "column_count": len(df.columns),
        "columns": df.columns,
        "dtypes": {r["column"]: r["dtype"] for r in rows},
        "missing_values": {r["column"]: r["missing"] for r in rows},
        "numeric_columns": numeric,
        "categorical_columns": categorical,
        "titles": {c: display_name(c) for c in df.columns},
        "warnings": warnings,
    }

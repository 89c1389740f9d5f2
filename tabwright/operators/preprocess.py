"""Imputation, scaling and one-hot encoding fitted exactly on training rows.

Fitted constants are compiled into a ``SQLTransformer`` and ready-made ML
models, so scoring is row-local and nothing is fitted again. Columns with more than
``LISTED`` categories keep them in a table, the dictionary, and rows get their place in it by a
join; such categories never pass through the driver.

All statistics come from three passes: counts of every category and class in long form, one
aggregate of counts, moments and ranges of the numbers, and one that reads off the medians.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.counts import is_missing, value_counts
from tabwright.operators.profile import wide_categories
from tabwright.operators.quantiles import exact_medians
from tabwright.operators.rownum import number_rows
from tabwright.operators.schema import FLOATING, quoted, require_columns
from tabwright.session import scratch_path, settle_any

# Categories of a column that the model itself lists; a column with more has a dictionary.
LISTED = 20_000
# Largest dictionary that is broadcast; larger ones are joined by a shuffle.
BROADCAST_CATEGORIES = 50_000
# Identifier warning: this many distinct values and this share of the rows.
WIDE_DISTINCT = 100


def feature_frame(df: DataFrame, features) -> DataFrame:
    """The expected feature columns in order; extra columns are ignored."""
    require_columns(df, features, "the model")
    return df.select(*[quoted(c) for c in features])


def empty_features(df: DataFrame, features) -> list:
    """Features without a single value."""
    fields = {f.name: f for f in df.schema.fields}
    seen = df.agg(
        *[F.count_if(~is_missing(fields[c])).alias(f"n{i}") for i, c in enumerate(features)]
    ).first()
    return [c for i, c in enumerate(features) if not seen[f"n{i}"]]


def wide_features(df: DataFrame, categorical) -> dict:
    """{column: distinct} of categorical features that look like identifiers."""
    return wide_categories(df, list(categorical), WIDE_DISTINCT)


def number_of(f: T.StructField):
    """Numeric feature as double with NaN as NULL; booleans are 0 and 1."""
    c = quoted(f.name)
    if isinstance(f.dataType, FLOATING):
        c = F.when(~F.isnan(c), c)
    return c.cast("double")


@dataclass(frozen=True)
class Dictionary:
    """(column, value, slot) at ``path``: the categories of wide columns, numbered in order.

    ``places`` gives each column's place among the categorical features, ``modes`` what fills
    its gaps.
    """

    path: str
    sizes: dict
    places: dict
    modes: dict

    def description(self) -> dict:
        return {"sizes": self.sizes, "places": self.places, "modes": self.modes}

    def add_slots(self, df: DataFrame) -> DataFrame:
        """``df`` with the slot of every wide column; an unknown category gets the last one."""
        words = df.sparkSession.read.parquet(self.path)
        for c, size in self.sizes.items():
            own = words.filter(F.col("column") == c).select(
                F.col("value").alias("tw_value"), F.col("slot").alias("tw_slot")
            )
            own = F.broadcast(own) if size <= BROADCAST_CATEGORIES else own
            key = F.coalesce(quoted(c).cast("string"), F.lit(self.modes[c]))
            slot = F.coalesce("tw_slot", F.lit(size)).cast("double").alias(f"tw_idx_{self.places[c]}")
            df = df.join(own, key == F.col("tw_value"), "left").select(*map(quoted, df.columns), slot)
        return df

    def sample(self, df: DataFrame) -> DataFrame:
        """``df`` with slot columns that carry nothing but the number of slots."""
        for c, size in self.sizes.items():
            kind = {"ml_attr": {"type": "nominal", "num_vals": size + 1}}
            df = df.withColumns({f"tw_idx_{self.places[c]}": F.lit(0.0)})
            df = df.withMetadata(f"tw_idx_{self.places[c]}", kind)
        return df


@dataclass(frozen=True)
class Preprocessing:
    numeric: tuple
    categorical: tuple
    medians: dict
    means: dict
    scales: dict
    modes: dict
    categories: dict
    dictionary: Dictionary | None = None

    def width(self) -> int:
        """Columns of the feature vector."""
        listed = sum(len(self.categories[c]) for c in self.categorical if c in self.categories)
        return len(self.numeric) + listed + (sum(self.dictionary.sizes.values()) if self.dictionary else 0)

    def scaled(self, name: str, dtype: T.DataType):
        """(x - mean) / scale of a numeric feature, gaps filled by the median."""
        filled = F.coalesce(number_of(T.StructField(name, dtype)), F.lit(self.medians[name]))
        return (filled - F.lit(self.means[name])) / F.lit(self.scales[name])

    def statement(self) -> str:
        """SQL of the row-local part, with the constants written out."""
        parts = ["*"]
        for i, c in enumerate(self.numeric):
            x = f"CAST({_name(c)} AS DOUBLE)"
            filled = f"coalesce(CASE WHEN NOT isnan({x}) THEN {x} END, {_double(self.medians[c])})"
            parts.append(
                f"({filled} - {_double(self.means[c])}) / {_double(self.scales[c])} AS tw_num_{i}"
            )
        for i, c in enumerate(self.categorical):
            if c in self.categories:
                parts.append(
                    f"coalesce(CAST({_name(c)} AS STRING), {_text(self.modes[c])}) AS tw_cat_{i}"
                )
        return f"SELECT {', '.join(parts)} FROM __THIS__"

    def transformers(self, sample: DataFrame) -> list:
        """Fitted ML stages ending in column ``tw_features``.

        ``sample`` only supplies the schema; fitting the encoder reads column
        metadata, not rows.
        """
        stages = [SQLTransformer(statement=self.statement())]
        blocks = [f"tw_num_{i}" for i in range(len(self.numeric))]
        if self.categorical:
            k = range(len(self.categorical))
            indexers = [
                StringIndexerModel.from_labels(
                    self.categories[c],
                    inputCol=f"tw_cat_{i}",
                    outputCol=f"tw_idx_{i}",
                    handleInvalid="keep",
                )
                for i, c in enumerate(self.categorical)
                if c in self.categories
            ]
            if self.dictionary:
                sample = self.dictionary.sample(sample)
            encoder = OneHotEncoder(
                inputCols=[f"tw_idx_{i}" for i in k],
                outputCols=[f"tw_hot_{i}" for i in k],
                dropLast=True,
            )
            stages += indexers
            stages.append(encoder.fit(PipelineModel(stages).transform(sample)))
            blocks += [f"tw_hot_{i}" for i in k]
        if not blocks:
            raise ValueError("there are no usable feature columns")
        return [*stages, VectorAssembler(inputCols=blocks, outputCol="tw_features")]


def _name(c):
    return "`" + c.replace("`", "``") + "`"


def _text(value):
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _double(value):
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def scale_statistics(df: DataFrame, medians: dict) -> DataFrame:
    """(column, mean, std, scale) after imputation; std is the population one
    and a constant column has scale 1."""
    fields = {f.name: f for f in df.schema.fields}
    columns = list(medians)
    filled = [F.coalesce(number_of(fields[c]), F.lit(medians[c])) for c in columns]
    one = df.agg(
        *[
            f(x).alias(f"{tag}{i}")
            for i, x in enumerate(filled)
            for tag, f in (("mean", F.avg), ("std", F.stddev_pop), ("low", F.min), ("high", F.max))
        ]
    )
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"mean{i}").alias("mean"),
                        F.col(f"std{i}").alias("std"),
                        F.when(
                            (F.col(f"low{i}") == F.col(f"high{i}")) | (F.col(f"std{i}") == 0), 1.0
                        )
                        .otherwise(F.col(f"std{i}"))
                        .alias("scale"),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )


@dataclass(frozen=True)
class Statistics:
    """What training needs to know of its rows, from ``training_statistics``.

    ``counts`` has (column, value, n) of the target and all categorical features, ``sizes``
    {column: (distinct values, rows with a value, most frequent value)} of the same columns and
    ``numbers`` {column: (rows with a value, mean, squared deviations, least, greatest)}.
    """

    rows: int
    counts: DataFrame
    sizes: dict
    numbers: dict = field(default_factory=dict)

    def empty(self) -> list:
        """Columns without a single value."""
        return [c for c, (_, n, _) in self.sizes.items() if not n] + [
            c for c, v in self.numbers.items() if not v[0]
        ]

    def scale(self, column: str, median: float) -> tuple[float, float]:
        """(mean, population deviation, 1 for a constant) after gaps are filled by the median.

        Filled rows are a second group of equal values, whose moments merge with the first's.
        """
        n, mean, squares, low, high = self.numbers[column]
        gaps = self.rows - n
        filled = mean + (median - mean) * gaps / self.rows
        total = squares + (median - mean) ** 2 * n * gaps / self.rows
        deviation = math.sqrt(max(total, 0.0) / self.rows)
        return filled, 1.0 if low == high or not deviation else deviation


def training_statistics(df: DataFrame, numeric, categorical, target=None) -> Statistics:
    """Counts of classes and categories, gaps and moments: two passes whatever the columns."""
    fields = {f.name: f for f in df.schema.fields}
    texts = [*categorical, *([target] if target is not None else [])]
    rows, numbers, counts, sizes = None, {}, None, {}
    if texts:
        counts, _ = settle_any(value_counts(df, texts))
        best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("minus"), "value")))
        summary = counts.groupBy("column").agg(
            F.count("value").alias("distinct"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("present"),
            F.sum("n").alias("rows"),
            best.alias("best"),  # ties go to the smallest value
        )
        seen = {r["column"]: r for r in summary.collect()}
        sizes = {
            c: (seen[c]["distinct"], seen[c]["present"], seen[c]["best"] and seen[c]["best"]["value"])
            if c in seen
            else (0, 0, None)
            for c in texts
        }
        rows = max((r["rows"] for r in seen.values()), default=0)
    if numeric or rows is None:
        values = [number_of(fields[c]) for c in numeric]
        kinds = (F.count, F.avg, F.var_pop, F.min, F.max)
        found = df.agg(
            F.count("*").alias("rows"),
            *[f(x).alias(f"v{i}_{k}") for i, x in enumerate(values) for k, f in enumerate(kinds)],
        ).first()
        rows = found["rows"]
        for i, c in enumerate(numeric):
            n, mean, variance, low, high = (found[f"v{i}_{k}"] for k in range(5))
            numbers[c] = (n, mean, (variance or 0.0) * n, low, high)
    return Statistics(rows, counts, sizes, numbers)


def fit_preprocessing(
    train: DataFrame, numeric, categorical, *, max_width: int | None = None,
    statistics: Statistics | None = None, listed: int = LISTED,
) -> Preprocessing:
    """Medians, means, population scales, modes and categories of ``train``.

    More one-hot columns than ``max_width`` are an error, never cut off.
    """
    numeric, categorical = tuple(numeric), tuple(categorical)
    if not numeric and not categorical:
        return Preprocessing((), (), {}, {}, {}, {}, {})
    known = statistics or training_statistics(train, numeric, categorical)
    medians, means, scales = {}, {}, {}
    if numeric:
        medians = exact_medians(train, numeric, sizes={c: known.numbers[c][0] for c in numeric})
        for c in numeric:
            if medians[c] is None:
                means[c] = scales[c] = None
            else:
                means[c], scales[c] = known.scale(c, medians[c])
    distinct = {c: known.sizes[c][0] for c in categorical}
    if max_width is not None and sum(distinct.values()) > max_width:
        raise ValueError(
            f"one-hot encoding needs more than {max_width} columns; "
            "drop identifier-like features or raise max_width"
        )
    modes = {c: known.sizes[c][2] for c in categorical if known.sizes[c][2] is not None}
    wide = [c for c in categorical if distinct[c] > listed]
    categories = {c: [] for c in categorical if c not in wide and distinct[c]}
    if categories:
        present = known.counts.filter(F.col("column").isin(list(categories)) & F.col("value").isNotNull())
        for r in present.select("column", "value").collect():
            categories[r["column"]].append(r["value"])
        categories = {c: sorted(v) for c, v in categories.items()}
    dictionary = None
    if wide:
        path = scratch_path(train.sparkSession, "dictionary")
        for c in wide:
            words = known.counts.filter((F.col("column") == c) & F.col("value").isNotNull())
            numbered = number_rows(words.select("column", "value"), "slot", 0, ["value"])
            numbered.write.mode("append").parquet(path)
        dictionary = Dictionary(
            path, {c: distinct[c] for c in wide}, {c: categorical.index(c) for c in wide}, {c: modes[c] for c in wide}
        )
    return Preprocessing(numeric, categorical, medians, means, scales, modes, categories, dictionary)


def class_weights(counts: DataFrame) -> DataFrame:
    """(class, n, weight) with weight = rows / (classes * n) from (class, n)."""
    every = Window.partitionBy(F.lit(1))  # one small row per class
    rows, classes = F.sum("n").over(every), F.count("*").over(every)
    return counts.select("class", "n", (rows / (classes * F.col("n"))).alias("weight"))

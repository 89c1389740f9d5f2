"""Feature recipes.

A recipe is compiled into one projection: every engineered column becomes an
expression over the source columns, so Spark sees a single Project node and
prunes and pushes down below it. Rule order is drop, dates, ages, logs, ratios,
target filter; later rules see the columns of earlier ones.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions import DEFAULT_DATE_FORMATS, date_parts, parse_timestamp, to_number
from tabwright.operators.counts import is_missing
from tabwright.operators.schema import header_problems, quoted

# Recipe fields a manifest stores.
RECIPE_FIELDS = (
    "drop_columns",
    "date_columns",
    "keep_date_columns",
    "age_from_year_columns",
    "reference_year",
    "log_columns",
    "ratio_features",
)


def parse_ratio(text: str):
    """``name=numerator/denominator`` as three stripped parts."""
    name, equals, rest = str(text).partition("=")
    numerator, slash, denominator = rest.partition("/")
    parts = tuple(p.strip() for p in (name, numerator, denominator))
    if not (equals and slash and all(parts)):
        raise ValueError(f"expected name=numerator/denominator, got {text!r}")
    return parts


@dataclass(frozen=True)
class FeatureRecipe:
    """Feature rules; everything but ``target_column`` is stored with a model."""

    target_column: str | None = None
    drop_columns: tuple = ()
    date_columns: tuple = ()
    keep_date_columns: bool = False
    age_from_year_columns: tuple = ()
    reference_year: int | None = None
    log_columns: tuple = ()
    ratio_features: tuple = ()
    ignore_missing_drops: bool = False
    date_formats: tuple = DEFAULT_DATE_FORMATS

    def __post_init__(self):
        if self.age_from_year_columns and self.reference_year is None:
            raise ValueError("age features need reference_year")
        for text in self.ratio_features:
            parse_ratio(text)

    def to_manifest(self) -> dict:
        values = asdict(self)
        return {
            k: list(values[k]) if isinstance(values[k], tuple) else values[k]
            for k in RECIPE_FIELDS
        }

    def generated_names(self) -> list:
        """Names the recipe creates, in order."""
        names = []
        for c in self.date_columns:
            names += list(date_parts(c, F.lit(None).cast("timestamp")))
        names += [f"{c}_age" for c in self.age_from_year_columns]
        names += [f"{c}_log1p" for c in self.log_columns]
        names += [parse_ratio(t)[0] for t in self.ratio_features]
        return names

    def operand_columns(self) -> list:
        """Columns that age, log and ratio rules read as numbers."""
        wanted = list(self.age_from_year_columns) + list(self.log_columns)
        for t in self.ratio_features:
            wanted += parse_ratio(t)[1:]
        return list(dict.fromkeys(wanted))


@dataclass(frozen=True)
class _Entry:
    expression: Column
    dtype: T.DataType


@dataclass(frozen=True)
class Warn:
    """A counter that goes with a rule; the text applies when the count is > 0."""

    rule: str
    column: str
    counted: Column
    text: str

    def message(self, count: int) -> str:
        return self.text.format(column=self.column, count=count)


class FeaturePlan:
    """A recipe bound to a table: ``frame`` is lazy, nothing runs on creation."""

    def __init__(self, source: DataFrame, recipe: FeatureRecipe):
        self.source = source
        self.recipe = recipe
        self.engineered: list = []
        self.warns: list = []
        problems = header_problems(source.columns)
        if problems:
            raise ValueError(f"unusable column names: {problems}")
        self._columns = {
            f.name: _Entry(quoted(f.name), f.dataType) for f in source.schema.fields
        }
        self._compile()

    # -- rules ---------------------------------------------------------------
    def _compile(self):
        r = self.recipe
        if r.target_column is not None:
            self._need([r.target_column], "the target")
            if r.target_column in r.drop_columns:
                raise ValueError("the target is listed in drop_columns")
        self._drop(r)
        self._need(r.date_columns, "date features")
        for c in r.date_columns:
            self._dates(c)
        self._need(r.age_from_year_columns, "age features")
        for c in r.age_from_year_columns:
            self._age(c)
        self._need(r.log_columns, "log features")
        for c in r.log_columns:
            self._log(c)
        for text in r.ratio_features:
            self._ratio(*parse_ratio(text))
        if r.target_column is not None:
            self._need([r.target_column], "the target")
            entry = self._columns[r.target_column]
            self._warn(
                "missing_target", r.target_column, entry.expression.isNull(),
                "{count} rows without a value in {column} were removed",
            )

    def _need(self, names, purpose):
        absent = sorted(set(names) - set(self._columns))
        if absent:
            raise ValueError(f"{purpose} needs columns the table does not have: {absent}")

    def _add(self, name, expression, dtype):
        if name in self._columns:
            raise ValueError(f"engineered column {name!r} is already in the table")
        self._columns[name] = _Entry(expression, dtype)
        self.engineered.append(name)

    def _warn(self, rule, column, test, text):
        self.warns.append(Warn(rule, column, F.count_if(test), text))

    def _number(self, name):
        e = self._columns[name]
        return to_number(e.expression, e.dtype)

    def _present(self, name):
        e = self._columns[name]
        if isinstance(e.dtype, (T.DoubleType, T.FloatType)):
            return e.expression.isNotNull() & ~F.isnan(e.expression)
        return e.expression.isNotNull()

    def _drop(self, r):
        drops = r.drop_columns
        if r.ignore_missing_drops:
            drops = [c for c in drops if c in self._columns]
        self._need(drops, "dropping")
        for c in drops:
            self._columns.pop(c, None)

    def _dates(self, name):
        entry = self._columns[name]
        parsed = parse_timestamp(entry.expression, entry.dtype, self.recipe.date_formats)
        if not isinstance(entry.dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            self._warn(
                "invalid_date", name, self._present(name) & parsed.isNull(),
                "{count} values of {column} are no dates; their date parts are missing",
            )
        for part, expression in date_parts(name, parsed).items():
            self._add(part, expression, T.IntegerType())
        if self.recipe.keep_date_columns:
            self._columns[name] = _Entry(parsed, T.TimestampType())
        else:
            del self._columns[name]

    def _age(self, name):
        year = self._number(name)
        whole = isinstance(self._columns[name].dtype, T.IntegralType)
        age = F.lit(int(self.recipe.reference_year)).cast("bigint") - year
        self._warn(
            "future_year", name, age < 0,
            f"{{count}} values of {{column}} lie after {self.recipe.reference_year}; "
            "their ages are missing",
        )
        self._add(
            f"{name}_age", F.when(age >= 0, age), T.LongType() if whole else T.DoubleType()
        )

    def _log(self, name):
        value = self._number(name)
        self._warn(
            "not_a_number", name, self._present(name) & value.isNull(),
            "{count} values of {column} are no numbers; their logs are missing",
        )
        self._warn(
            "negative_log", name, value < 0,
            "{count} values of {column} are negative; their logs are missing",
        )
        self._add(
            f"{name}_log1p",
            F.when(value >= 0, F.log1p(value.cast("double"))),
            T.DoubleType(),
        )

    def _ratio(self, name, numerator, denominator):
        self._need([numerator, denominator], f"ratio {name}")
        top = self._number(numerator).cast("double")
        bottom = self._number(denominator).cast("double")
        self._warn(
            "zero_denominator", name, bottom == 0,
            "ratio {column} has {count} zero denominators; those ratios are missing",
        )
        ratio = F.try_divide(top, bottom)
        self._add(name, F.when(~F.isnan(ratio), ratio), T.DoubleType())

    # -- results -------------------------------------------------------------
    def columns(self) -> list:
        return list(self._columns)

    def frame(self, observation: Observation | None = None, keep_originals: bool = False):
        """The feature table.

        ``observation`` collects the warning counters while the result is
        written; they are taken before rows without a target are removed. Use it
        only when no shuffle follows before the write, because a map stage that
        runs again after losing an executor would count its rows twice.
        ``keep_originals`` also returns source columns the recipe removed.
        """
        df = self.source
        if observation is not None:
            df = df.observe(observation, *self.counters(), F.count("*").alias("input_rows"))
        outputs = [e.expression.alias(n) for n, e in self._columns.items()]
        if keep_originals:
            outputs += [quoted(c) for c in df.columns if c not in self._columns]
        target = self.recipe.target_column
        if target is not None:
            fields = {f.name: f for f in self.source.schema.fields}
            if target in fields:
                df = df.filter(~is_missing(fields[target]))
        return df.select(*outputs)

    def counters(self) -> list:
        return [w.counted.alias(f"w{i}") for i, w in enumerate(self.warns)]

    def warning_counts(self) -> DataFrame:
        """(rule, column, rows) for every rule, zero counts too: one aggregate."""
        rows = self.source.agg(F.count("*").alias("input_rows"), *self.counters())
        entries = F.array(
            *[
                F.struct(
                    F.lit(w.rule).alias("rule"),
                    F.lit(w.column).alias("column"),
                    F.col(f"w{i}").alias("rows"),
                )
                for i, w in enumerate(self.warns)
            ]
        )
        if not self.warns:
            return rows.select(
                F.lit("").alias("rule"), F.lit("").alias("column"), F.col("input_rows").alias("rows")
            ).limit(0)
        return rows.select(F.inline(entries))

    def messages(self, counts: dict) -> list:
        """Texts for the counters that are not zero; ``counts`` maps w0, w1, …"""
        return [
            w.message(counts[f"w{i}"]) for i, w in enumerate(self.warns) if counts[f"w{i}"]
        ]


def feature_table(df: DataFrame, recipe: FeatureRecipe) -> DataFrame:
    """The recipe applied to ``df``, lazily."""
    return FeaturePlan(df, recipe).frame()



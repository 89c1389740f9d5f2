"""Scoring rows with a saved model. Row-local, so it also works on streams."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain, count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.errors import ArtifactError
from tabwright.functions import safe_label
from tabwright.operators.rownum import number_rows, number_scan_rows
from tabwright.operators.schema import nulls_only, quoted, repeated_names, require_columns


@dataclass(frozen=True)
class ScoreResult:
    frame: DataFrame
    prediction_column: str
    probability_columns: tuple


def probability_names(classes, used) -> list:
    """``probability_<label>`` per class; a taken name gets the next free number from 2."""
    taken = set(used)

    def free(base: str) -> str:
        numbered = chain([base], (f"{base}_{k}" for k in count(2)))
        name = next(n for n in numbered if n not in taken)
        taken.add(name)
        return name

    return [free(f"probability_{safe_label(label)}") for label in classes]


def score_table(
    df: DataFrame,
    artifact,
    *,
    prediction_column: str | None = None,
    include_input: bool = True,
    include_probabilities: bool = True,
    key_columns=(),
    keep=None,
    from_files: bool = False,
) -> ScoreResult:
    """Add the predicted label and one probability per class.

    Without input columns the output has ``key_columns``, or a 0-based
    ``source_row`` when there are none. ``keep`` names the input columns to
    return when not all of them. ``from_files`` says that ``df`` is read from files and not
    shuffled since, so its rows are numbered in file order without writing them.
    """
    if repeated_names(df.columns):
        raise ValueError(f"column names are used twice: {repeated_names(df.columns)}")
    require_columns(df, artifact.feature_columns, "the model")
    target = prediction_column if prediction_column is not None else f"predicted_{artifact.target_column}"
    if not target.strip():
        raise ValueError("prediction_column must not be blank")
    if include_input:
        out = list(keep if keep is not None else df.columns)
    elif key_columns:
        require_columns(df, key_columns, "row keys")
        out = list(key_columns)
    else:
        df = (number_scan_rows if from_files else number_rows)(df, "source_row")
        out = ["source_row"]
    if target in out:
        raise ValueError(f"column {target!r} is already in the table")

    scored = artifact.transform(nulls_only(df))
    classes = list(artifact.classes)
    last = artifact.pipeline.stages[-1] if artifact.forest is None else None
    fitted = artifact.forest.classes if last is None else getattr(last, "numClasses", len(classes))
    if fitted != len(classes):
        raise ArtifactError("the model and its description have different class counts")
    label = F.element_at(
        F.array(*[F.lit(c) for c in classes]), (F.col("prediction") + 1).cast("int")
    )
    names = []
    outputs = [quoted(c) for c in out] + [label.alias(target)]
    if include_probabilities:
        names = probability_names(classes, [*out, target])
        outputs += [F.get("probability", F.lit(i)).alias(n) for i, n in enumerate(names)]
    return ScoreResult(scored.select(*outputs), target, tuple(names))


def prediction_distribution(df: DataFrame, prediction: str) -> DataFrame:
    """(prediction, n), most frequent first."""
    return (
        df.groupBy(quoted(prediction).alias("prediction"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), F.col("prediction"))
    )


def probability_table(df: DataFrame, keys, probability_columns, classes) -> DataFrame:
    """(keys…, class, probability) long form of the probability columns."""
    pairs = F.array(
        *[
            F.struct(F.lit(str(c)).alias("class"), quoted(p).alias("probability"))
            for c, p in zip(classes, probability_columns)
        ]
    )
    return df.select(*[quoted(k) for k in keys], F.inline(pairs))


def with_confidence(df: DataFrame, probability_columns, name: str = "confidence") -> DataFrame:
    """Add the highest class probability."""
    columns = [quoted(p) for p in probability_columns]
    return df.withColumn(name, F.greatest(*columns) if len(columns) > 1 else columns[0])


def rule_counts(df: DataFrame, rules: dict) -> DataFrame:
    """(rule, rows) where a cross-column predicate holds; one aggregate.

    ``rules`` maps a rule name to a boolean Column.
    """
    one = df.agg(*[F.count_if(test).alias(f"r{i}") for i, test in enumerate(rules.values())])
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("rows"))
                    for i, n in enumerate(rules)
                ]
            )
        )
    )

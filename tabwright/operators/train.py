"""Fitting classifiers on prepared feature tables."""

from __future__ import annotations

import math
import os
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.java import java_object
from tabwright.operators.counts import as_text, is_missing
from tabwright.operators.forest import ForestSpec, fit_forest
from tabwright.operators.preprocess import (
    LISTED,
    WIDE_DISTINCT,
    feature_frame,
    fit_preprocessing,
    training_statistics,
)
from tabwright.operators.schema import nulls_only, quoted, require_columns, training_roles
from tabwright.session import TASK_ROWS, settle, shared_dir, spread
from tabwright.sources.artifacts import ModelArtifact

MODEL_TYPES = ("logistic_regression", "random_forest", "exact_forest")
# Deepest tree Spark can grow; stands for unlimited depth.
DEEPEST = 30
JAVA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "CountedForest.java")


@dataclass(frozen=True)
class TrainSpec:
    """``random_forest`` is Spark ML's (binned thresholds, depth 30 at most); ``exact_forest``
    has neither limit and reads ``bootstrap`` and ``subtree_bytes``. A category with more than
    ``listed`` values is encoded through a dictionary table."""

    target_column: str
    model_type: str = "logistic_regression"
    seed: int = 42
    max_iter: int = 2000
    n_estimators: int = 300
    max_depth: int = DEEPEST
    max_bins: int = 32
    most_coefficients: int = 20_000_000
    class_weight: str | None = "balanced"
    inverse_regularization: float = 1.0
    tolerance: float = 1e-6
    bootstrap: bool = True
    subtree_bytes: int = ForestSpec.subtree_bytes
    listed: int = LISTED

    def __post_init__(self):
        if self.model_type not in MODEL_TYPES:
            raise ValueError(f"model_type must be one of {list(MODEL_TYPES)}")
        if self.max_iter < 1 or self.n_estimators < 1:
            raise ValueError("max_iter and n_estimators must be positive")
        if self.class_weight not in (None, "balanced"):
            raise ValueError("class_weight is 'balanced' or None")


def with_target(df: DataFrame, target: str) -> DataFrame:
    """Rows that have a target value."""
    require_columns(df, [target], "the target")
    field = {f.name: f for f in df.schema.fields}[target]
    return df.filter(~is_missing(field))


def class_sizes(statistics, field, most: int = 10_000) -> dict:
    """{class: rows} in sorted class order; an error when the target is
    continuous, so the driver never sees more than ``most`` classes."""
    if statistics.sizes[field.name][0] > most:
        raise ValueError(f"the target {field.name!r} has more than {most} classes")
    own = statistics.counts.filter((F.col("column") == field.name) & F.col("value").isNotNull())
    rows = own.select(F.col("value").cast(field.dataType).alias("label"), "n").collect()
    return dict(sorted((r["label"], r["n"]) for r in rows))


def pattern_counts(df: DataFrame, target: str, most: int) -> DataFrame:
    """Rows that agree in the target and in every category as one, their number in ``tw_rows``.

    There are at most ``most`` of them, few enough for one task.
    """
    texts = [quoted(f.name) if f.name == target else as_text(f).alias(f.name) for f in df.schema.fields]
    counted = df.select(*texts).groupBy(*map(quoted, df.columns)).agg(F.count("*").alias("tw_rows"))
    return settle(counted, most).coalesce(1)


def without_summary(model):
    """Drop the training summary: it refers to the session and the training rows,
    would travel with every scoring task and may not be serializable."""
    none = SparkContext._active_spark_context._jvm.scala.Option.apply(None)
    model._java_obj.setSummary(none)
    return model


def fit_counted(estimator: RandomForestClassifier, matrix: DataFrame, classes: int):
    """``estimator`` fitted by CountedForest.java: Spark ML's trees on rows counted by their bins."""
    estimator._transfer_params_to_java()
    counted = java_object(matrix.sparkSession, JAVA, "tabwright.CountedForest")
    model = estimator._create_model(counted.fit(estimator._java_obj, matrix._jdf, classes, TASK_ROWS))
    return estimator._copyValues(model)


def fit_model(train: DataFrame, spec: TrainSpec):
    """(artifact, training rows, warnings) of a classifier fitted on ``train``.

    Every statistic comes from training rows alone. Rows without a target are
    left out.
    """
    rows = with_target(nulls_only(train), spec.target_column)
    features = [c for c in rows.columns if c != spec.target_column]
    if not features:
        raise ValueError("there are no feature columns")
    numeric, categorical = training_roles(rows, spec.target_column)
    field = {f.name: f for f in rows.schema.fields}[spec.target_column]
    known = training_statistics(rows, numeric, categorical, spec.target_column)
    per_class = class_sizes(known, field)
    total = sum(per_class.values())
    if not total:
        raise ValueError("no training row has a target value")
    if len(per_class) < 2:
        raise ValueError("the target needs at least two classes")
    empty = [c for c in features if c in known.empty()]
    if empty:
        raise ValueError(f"these features have no values at all: {empty}")
    wide = [c for c in categorical if known.sizes[c][0] > max(WIDE_DISTINCT, 0.5 * total)]
    warnings = [
        f"{c} has {known.sizes[c][0]} distinct values; drop identifiers before training" for c in wide
    ]

    plan = fit_preprocessing(rows, numeric, categorical, statistics=known, listed=spec.listed)
    stages = plan.transformers(feature_frame(rows, features))
    classes = list(per_class)
    width = plan.width()
    if width * len(classes) > spec.most_coefficients:
        raise ValueError(
            f"{width} feature columns for {len(classes)} classes are more than "
            f"{spec.most_coefficients} coefficients; drop wide features or raise most_coefficients"
        )
    label = F.array_position(F.array(*[F.lit(c) for c in classes]), quoted(spec.target_column)) - 1
    nominal = {"ml_attr": {"type": "nominal", "vals": [str(c) for c in classes], "name": "tw_label"}}
    weights = {c: total / (len(classes) * n) for c, n in per_class.items()}
    weight = F.lit(1.0)
    if spec.class_weight == "balanced":
        weight = F.element_at(
            F.array(*[F.lit(weights[c]) for c in classes]), (label + 1).cast("int")
        )
    patterns = math.prod(known.sizes[c][0] + 1 for c in categorical) * len(classes)
    if spec.model_type == "logistic_regression" and not numeric and patterns <= min(total, TASK_ROWS):
        # the solver reads the rows at every step; equal rows are one of their total weight
        rows = pattern_counts(rows, spec.target_column, patterns)
        weight = weight * F.col("tw_rows")
    slotted = plan.dictionary.add_slots(rows) if plan.dictionary else rows
    matrix = PipelineModel(stages).transform(slotted).select(
        "tw_features",
        label.cast("double").alias("tw_label", metadata=nominal),
        weight.alias("tw_weight"),
    )
    columns = dict(featuresCol="tw_features", labelCol="tw_label", weightCol="tw_weight")
    forest = None
    if spec.model_type != "logistic_regression":
        # a small file is one task however many trees there are
        matrix = spread(matrix, total)
    if spec.model_type == "exact_forest":
        own = [weights[c] if spec.class_weight == "balanced" else 1.0 for c in classes]
        grown = ForestSpec(spec.n_estimators, spec.seed, spec.bootstrap, spec.subtree_bytes)
        forest, last = fit_forest(matrix, own, grown)
    elif spec.model_type == "logistic_regression":
        # Spark averages the loss over the weights, whose sum is the row count
        # in both weighting modes; dividing the penalty the same way gives
        # sum(w * loss) + |b|^2 / (2 C).
        estimator = LogisticRegression(
            **columns,
            maxIter=spec.max_iter,
            tol=spec.tolerance,
            regParam=1.0 / (spec.inverse_regularization * total),
            elasticNetParam=0.0,
            standardization=False,
            family="binomial" if len(classes) == 2 else "multinomial",
        )
    else:
        shared_dir(rows.sparkSession)
        estimator = RandomForestClassifier(
            **columns,
            numTrees=spec.n_estimators,
            maxDepth=spec.max_depth,
            maxBins=spec.max_bins,
            featureSubsetStrategy="sqrt",
            minInstancesPerNode=1,
            seed=spec.seed,
            cacheNodeIds=True,
            maxMemoryInMB=512,
        )
    if forest is None:
        # a forest of many rows counts those that its bins do not tell apart
        counted = spec.model_type == "random_forest" and total > TASK_ROWS
        fitted = fit_counted(estimator, matrix, len(classes)) if counted else estimator.fit(matrix)
        last = [without_summary(fitted)]
    artifact = ModelArtifact(
        pipeline=PipelineModel([*stages, *last]),
        target_column=spec.target_column,
        feature_columns=tuple(features),
        numeric_columns=tuple(numeric),
        categorical_columns=tuple(categorical),
        classes=tuple(classes),
        model_type=spec.model_type,
        random_state=spec.seed,
        categories={c: tuple(v) for c, v in plan.categories.items()},
        forest=forest,
        dictionary=plan.dictionary,
    )
    return artifact, total, tuple(warnings)

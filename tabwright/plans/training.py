"""Features, split, fit, evaluation and manifest."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tabwright.operators.features import FeaturePlan, FeatureRecipe
from tabwright.operators.metrics import evaluate_predictions
from tabwright.operators.score import score_table
from tabwright.operators.schema import quoted
from tabwright.operators.split import SPLITS, SplitSpec, split_table
from tabwright.operators.train import TrainSpec, fit_model, with_target
from tabwright.plans.manifest import manifest_record, save_manifest
from tabwright.sources.artifacts import ModelArtifact, load_artifact, save_artifact
from tabwright.sources.files import exists, protect_outputs, write_json
from tabwright.sources.publish import clear, finish, publish, staged
from tabwright.sources.tables import read_table, write_table


FORESTS = ("random_forest", "exact_forest")


@dataclass(frozen=True)
class FeatureBuild:
    path: str
    engineered: tuple
    input_rows: int
    output_rows: int
    dropped_target_rows: int
    split_rows: dict = field(default_factory=dict)
    warnings: tuple = ()


def build_features(
    spark, source: str, output: str, recipe: FeatureRecipe, split: SplitSpec | None, *,
    overwrite: bool = False, **reading,
) -> FeatureBuild:
    """Features of a stored table, split and written as one table partitioned by
    ``split`` (or unsplit without a target). Metadata goes to a JSON beside it."""
    protect_outputs(spark, [output], [source], overwrite)
    table = read_table(spark, source, **reading)
    plan = FeaturePlan(table, recipe)
    frame, sizes, by, split_warning = plan.frame(), {}, (), None

    def counted():
        return table.agg(F.count("*").alias("input_rows"), *plan.counters()).first().asDict()

    def missing_targets(counts):
        return sum(counts[f"w{i}"] for i, w in enumerate(plan.warns) if w.rule == "missing_target")

    if frame.isEmpty():
        counts = counted()
        if not counts["input_rows"]:
            raise ValueError("the source table has no rows")
        if counts["input_rows"] == missing_targets(counts):
            raise ValueError("no row has a target value")
    # source rows and warnings are counted by the write itself, unless rows are read more than
    # once there or shuffled
    seen, written = Observation("seen"), Observation("written")
    observed, one_pass = plan.frame(seen), True
    if recipe.target_column is not None and split is not None:
        spec = replace(split, target_column=recipe.target_column)
        result = split_table(frame, spec, observed)
        split_warning, one_pass = result.warning, result.one_pass
        totals = result.quotas.agg(*[F.sum(s).alias(s) for s in SPLITS]).first()
        sizes = {s: totals[s] for s, f in zip(SPLITS, spec.fractions) if f > 0}
        by = ("split",)
        frame = result.frame.observe(written, *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS])
    else:
        frame = observed
    counts = {} if one_pass else counted()
    write_table(frame, output, overwrite=overwrite, partition_by=by, allowed=("csv", "parquet"))
    if by and {s: n for s, n in written.get.items() if n} != {s: n for s, n in sizes.items() if n}:
        raise RuntimeError(f"rows written per split {written.get} are not the quotas {sizes}")
    counts = counts or seen.get
    dropped = missing_targets(counts)
    kept = counts["input_rows"] - dropped
    warnings = plan.messages(counts) + ([split_warning] if split_warning else [])
    report = FeatureBuild(
        output, tuple(plan.engineered), counts["input_rows"], kept, dropped, sizes, tuple(warnings)
    )
    write_json(
        spark,
        {
            "feature_build_config": recipe.to_manifest(),
            "target_column": recipe.target_column,
            "input_rows": report.input_rows,
            "output_rows": report.output_rows,
            "dropped_target_rows": dropped,
            "columns": plan.columns(),
            "dtypes": {f.name: f.dataType.simpleString() for f in frame.schema.fields if f.name not in by},
            "engineered_features": plan.engineered,
            "split_rows": sizes,
            "warnings": warnings,
        },
        metadata_path(output),
    )
    return report


def metadata_path(output: str) -> str:
    return str(output).rstrip("/") + ".metadata.json"


def read_split(spark, path: str, name: str) -> DataFrame:
    """One split of a feature table; the partition filter prunes the others."""
    return read_table(spark, path).filter(F.col("split") == name).drop("split")


def evaluate_table(df: DataFrame, artifact: ModelArtifact) -> dict:
    """Metrics of ``artifact`` on labelled rows; rows without a target are counted
    and left out."""
    target = artifact.target_column
    labelled = with_target(df, target)
    if artifact.model_type in FORESTS:  # hundreds of trees for every row, even of a small file
        labelled = labelled.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)
    scored = score_table(labelled, artifact, prediction_column="tw_prediction")
    p = F.array(*[quoted(c) for c in scored.probability_columns])
    metrics = evaluate_predictions(scored.frame, target, "tw_prediction", artifact.classes, p)
    rows = int(metrics["classification_report"]["weighted avg"]["support"] or 0)
    if not rows:
        raise ValueError("no row has a target value")
    return {"evaluated_rows": rows, "metrics": metrics}


@dataclass(frozen=True)
class Training:
    artifact: ModelArtifact
    train_rows: int
    evaluation_dataset: str
    metrics: dict
    warnings: tuple


def train_table(train: DataFrame, validation: DataFrame | None, spec: TrainSpec) -> Training:
    """Fit on ``train``; metrics come from ``validation``, else from ``train``
    with a warning."""
    artifact, rows, warnings = fit_model(train, spec)
    name = "validation"
    if validation is None:
        name, validation = "training", train
        warnings = (*warnings, "no validation rows: metrics are of the training rows")
    return Training(artifact, rows, name, evaluate_table(validation, artifact), warnings)


def sibling_validation(spark, train: str) -> str | None:
    """The table beside ``train`` whose name says validation instead, if it exists."""
    folder, slash, name = str(train).rstrip("/").rpartition("/")
    head, found, tail = name.rpartition("train")
    path = f"{folder}{slash}{head}validation{tail}"
    return path if found and exists(spark, path) else None


def train_path(
    spark, train: str, model: str, report: str, spec: TrainSpec, *,
    validation: str | None = None, overwrite: bool = False, **reading,
) -> Training:
    """Fit on a stored table, and save model and metrics.

    Metrics come from ``validation``, else from the validation table beside the training
    table, else from the training rows with a warning.
    """
    if validation is not None and not exists(spark, validation):
        raise FileNotFoundError(f"no validation table at {validation}")
    validation = validation or sibling_validation(spark, train)
    sources = [train] if validation is None else [train, validation]
    protect_outputs(spark, [model, report], sources, overwrite)
    held = None if validation is None else read_table(spark, validation, **reading)
    fitted = train_table(read_table(spark, train, **reading), held, spec)
    save_artifact(spark, fitted.artifact, model, overwrite=overwrite)
    write_json(
        spark,
        {
            **fitted.artifact.description(),
            "model_path": model,
            "training_rows": fitted.train_rows,
            "evaluation_dataset": fitted.evaluation_dataset,
            **fitted.metrics,
        },
        report,
        overwrite,
    )
    return fitted


def evaluate_path(spark, data: str, model: str, report: str, *, overwrite=False, **reading) -> dict:
    """Evaluate a stored model on a stored table and save the metrics."""
    protect_outputs(spark, [report], [data, model], overwrite)
    artifact = load_artifact(spark, model)
    table = read_table(spark, data, **reading)
    total = table.count()
    result = evaluate_table(table, artifact)
    result["dropped_target_rows"] = total - result["evaluated_rows"]
    write_json(spark, {"model_path": model, "data_path": data, **result}, report, overwrite)
    return result


@dataclass(frozen=True)
class TrainingPaths:
    source: str
    features: str
    model: str
    training_metrics: str
    evaluation_metrics: str
    manifest: str


@dataclass(frozen=True)
class TrainingRun:
    features: FeatureBuild
    training: Training
    evaluation: dict
    manifest: dict


def run_training(
    spark, paths: TrainingPaths, recipe: FeatureRecipe, split: SplitSpec, train: TrainSpec, *,
    overwrite: bool = False, **reading,
) -> TrainingRun:
    """Preflight, features and split, fit, test evaluation, manifest.

    Model, metrics and manifest are published together when all are written: a run that stops
    earlier leaves the old ones. Features are a table of their own and written in place.
    """
    if split.validation <= 0 or split.test <= 0:
        raise ValueError("training needs validation and test rows")
    if recipe.target_column != train.target_column:
        raise ValueError("the recipe and the training name different targets")
    outputs = [
        paths.features, metadata_path(paths.features), paths.model, paths.training_metrics,
        paths.evaluation_metrics, paths.manifest,
    ]
    together = [paths.model, paths.training_metrics, paths.evaluation_metrics, paths.manifest]
    finish(spark, paths.manifest)
    protect_outputs(spark, outputs, [paths.source], overwrite)
    clear(spark, together)
    built = build_features(
        spark, paths.source, paths.features, recipe, split, overwrite=overwrite, **reading
    )
    fitted = train_table(
        read_split(spark, paths.features, "train"),
        read_split(spark, paths.features, "validation"),
        train,
    )
    save_artifact(spark, fitted.artifact, staged(paths.model))
    write_json(
        spark,
        {
            **fitted.artifact.description(),
            "model_path": paths.model,
            "training_rows": fitted.train_rows,
            "evaluation_dataset": fitted.evaluation_dataset,
            **fitted.metrics,
        },
        staged(paths.training_metrics),
    )
    evaluation = evaluate_table(read_split(spark, paths.features, "test"), fitted.artifact)
    write_json(spark, {"model_path": paths.model, **evaluation}, staged(paths.evaluation_metrics))

    def headline(block, *names):
        return {n: block["metrics"][n] for n in names}

    manifest = manifest_record(
        fitted.artifact,
        recipe,
        paths.model,
        source_path=paths.source,
        processed_datasets={s: f"{paths.features}/split={s}" for s in built.split_rows},
        training_metrics_path=paths.training_metrics,
        evaluation_metrics_path=paths.evaluation_metrics,
        validation_metrics=headline(fitted.metrics, "accuracy", "f1_weighted"),
        test_metrics=headline(evaluation, "accuracy", "balanced_accuracy", "f1_weighted"),
    )
    save_manifest(spark, manifest, staged(paths.manifest), True)
    publish(spark, paths.manifest, together)
    return TrainingRun(built, fitted, evaluation, manifest)

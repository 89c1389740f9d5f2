"""Scoring new rows with a model and the recipe stored beside it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.features import FeaturePlan
from tabwright.operators.schema import require_columns
from tabwright.operators.score import ScoreResult, score_table
from tabwright.plans.manifest import (
    check_compatible,
    check_pair,
    load_manifest,
    recipe_from_manifest,
)
from tabwright.sources.artifacts import ModelArtifact, load_artifact
from tabwright.sources.files import protect_outputs
from tabwright.sources.publish import finish
from tabwright.sources.tables import read_table, write_table

STAGES = ("auto", "cleaned", "processed")


def resolve_stage(stage: str, columns, features) -> str:
    """``auto`` is ``processed`` when every model feature is there already."""
    if stage not in STAGES:
        raise ValueError(f"input stage must be one of {list(STAGES)}")
    if stage != "auto":
        return stage
    return "processed" if set(features) <= set(columns) else "cleaned"


def inference_features(df: DataFrame, manifest: dict, *, keep_originals=True, **options):
    """(feature table, plan): the stored recipe without target. No row is added
    or removed; original columns the recipe drops are kept on request."""
    plan = FeaturePlan(df, recipe_from_manifest(manifest, **options))
    frame = plan.frame(keep_originals=keep_originals)
    require_columns(frame, manifest["expected_feature_columns"], "the model")
    return frame, plan


@dataclass(frozen=True)
class Resources:
    """A checked model and manifest pair."""

    artifact: ModelArtifact
    manifest: dict


def load_resources(spark, model_path: str, manifest_path: str) -> Resources:
    finish(spark, manifest_path)
    artifact = load_artifact(spark, model_path)
    manifest = load_manifest(spark, manifest_path)
    check_pair(manifest, artifact)
    return Resources(artifact, manifest)


def score_with_recipe(
    df: DataFrame,
    resources: Resources,
    *,
    input_stage: str = "cleaned",
    prediction_column: str | None = None,
    include_input: bool = True,
    include_probabilities: bool = True,
    key_columns=(),
    ignore_missing_drops: bool = False,
    from_files: bool = False,
) -> ScoreResult:
    """Original columns plus prediction and probabilities.

    One lazy row-local plan, so ``df`` may be a stream. The engineered features
    are used but not returned.
    """
    if input_stage not in ("cleaned", "processed"):
        raise ValueError("input_stage is 'cleaned' or 'processed'")
    originals = df.columns
    if input_stage == "cleaned":
        df, _ = inference_features(
            df, resources.manifest, in_memory=True, ignore_missing_drops=ignore_missing_drops
        )
    return score_table(
        df,
        resources.artifact,
        prediction_column=prediction_column,
        include_input=include_input,
        include_probabilities=include_probabilities,
        key_columns=key_columns,
        keep=originals,
        from_files=from_files,
    )


@dataclass(frozen=True)
class InferenceRun:
    stage: str
    output: str
    rows: int
    prediction_column: str
    probability_columns: tuple
    engineered: tuple = ()
    warnings: tuple = ()


def run_inference(
    spark,
    data: str,
    model: str,
    manifest: str,
    output: str,
    *,
    features_output: str | None = None,
    input_stage: str = "auto",
    prediction_column: str | None = None,
    include_input: bool = True,
    include_probabilities: bool = True,
    preserve_original_columns: bool = True,
    key_columns=(),
    overwrite: bool = False,
    **reading,
) -> InferenceRun:
    """Score a stored table: read, features, model, write, as one plan.

    The feature table is stored too when ``features_output`` is given. Output
    rows hold features and originals; without input columns they hold
    ``key_columns``, or row numbers when there are none.
    """
    finish(spark, manifest)
    artifact = load_artifact(spark, model)
    table = read_table(spark, data, **reading)
    stage = resolve_stage(input_stage, table.columns, artifact.feature_columns)
    inputs, outputs = [data, model], [output]
    if stage == "cleaned":
        inputs.append(manifest)
        outputs += [features_output] if features_output else []
    protect_outputs(spark, outputs, inputs, overwrite)
    engineered, warnings, frame = (), (), table
    counters = []
    if stage == "cleaned":
        record = load_manifest(spark, manifest)
        check_compatible(record, artifact)
        frame, plan = inference_features(table, record, keep_originals=preserve_original_columns or bool(key_columns))
        engineered = tuple(plan.engineered)
        counters = plan.counters()
    counts = table.agg(F.count("*").alias("input_rows"), *counters).first().asDict()
    if not counts["input_rows"]:
        raise ValueError("the table to score has no rows")
    if stage == "cleaned":
        warnings = tuple(plan.messages(counts))
        if features_output:
            write_table(frame, features_output, overwrite=overwrite, allowed=("csv", "parquet"))
    result = score_table(
        frame,
        artifact,
        prediction_column=prediction_column,
        include_input=include_input,
        include_probabilities=include_probabilities,
        key_columns=key_columns,
        from_files=True,
    )
    write_table(result.frame, output, overwrite=overwrite, allowed=("csv", "parquet"))
    return InferenceRun(
        stage, output, counts["input_rows"], result.prediction_column,
        result.probability_columns, engineered, warnings,
    )


def score_path(spark, data: str, model: str, output: str, *, overwrite=False, reading=None, **options):
    """Score a stored feature table with a stored model."""
    protect_outputs(spark, [output], [data, model], overwrite)
    result = score_table(
        read_table(spark, data, **(reading or {})),
        load_artifact(spark, model),
        **{"from_files": True, **options},
    )
    write_table(result.frame, output, overwrite=overwrite, allowed=("csv", "parquet"))
    return result

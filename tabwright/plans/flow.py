"""The complete flow of a table: checks, cleaning, training, quality gate and package."""

from __future__ import annotations

from dataclasses import dataclass

from tabwright.operators.clean import CleaningSpec
from tabwright.operators.features import FeatureRecipe
from tabwright.operators.metrics import quality_gate
from tabwright.operators.split import SplitSpec
from tabwright.operators.train import TrainSpec
from tabwright.operators.validate import ValidationRules
from tabwright.plans.manifest import package_manifest, save_manifest
from tabwright.plans.prepare import Preparation, prepare_path
from tabwright.plans.training import TrainingPaths, TrainingRun, run_training
from tabwright.session import small_table


@dataclass(frozen=True)
class Flow:
    preparation: Preparation
    training: TrainingRun
    decision: dict
    package_path: str


def run_flow(
    spark,
    source: str,
    base: str,
    rules: ValidationRules,
    cleaning: CleaningSpec,
    recipe: FeatureRecipe,
    split: SplitSpec,
    train: TrainSpec,
    *,
    before: ValidationRules | None = None,
    gate_metric: str = "f1_weighted",
    gate_minimum: float = 0.6,
    overwrite: bool = False,
    **reading,
) -> Flow:
    """Run everything below the folder ``base``.

    The raw table must pass ``before`` (default: missing fractions and repeats of
    ``rules``), the cleaned one ``rules`` with repeated rows fatal. Both raise. The gate
    judges the test metrics; a rejected model is packaged as well, with its decision.
    """
    base = str(base).rstrip("/")
    preparation = prepare_path(
        spark, source, f"{base}/raw", f"{base}/cleaned.parquet", rules, cleaning,
        overwrite=overwrite, repeats_are_fatal=True, before=before, **reading,
    )
    paths = TrainingPaths(
        preparation.cleaned_path, f"{base}/features.parquet", f"{base}/model",
        f"{base}/training.json", f"{base}/evaluation.json", f"{base}/manifest.json",
    )
    run = run_training(spark, paths, recipe, split, train, overwrite=overwrite)
    measured = run.evaluation["metrics"]
    row = small_table(spark, [(measured[gate_metric],)], f"{gate_metric} double")
    decision = quality_gate(row, gate_metric, gate_minimum).first().asDict()
    package = package_manifest(
        spark, run.training.artifact, recipe, paths.model, run.training.metrics["metrics"], measured
    )
    path = f"{base}/package.json"
    save_manifest(spark, {**package, "gate": decision}, path, overwrite)
    return Flow(preparation, run, decision, path)

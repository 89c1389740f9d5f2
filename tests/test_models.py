import math

import numpy as np
import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tabwright.errors import ArtifactError
from tabwright.operators.features import FeatureRecipe
from tabwright.operators.metrics import (
    EPSILON,
    class_report,
    confusion_matrix,
    evaluate_predictions,
    log_loss,
    metrics_from_counts,
    quality_gate,
    summary_metrics,
)
from tabwright.operators.preprocess import class_weights, fit_preprocessing, wide_features
from tabwright.operators.score import (
    prediction_distribution,
    probability_names,
    probability_table,
    score_table,
    with_confidence,
)
from tabwright.operators.split import SplitSpec
from tabwright.operators.train import TrainSpec, fit_model
from tabwright.plans.inference import (
    Resources,
    load_resources,
    resolve_stage,
    run_inference,
    score_path,
    score_with_recipe,
)
from tabwright.plans.manifest import (
    check_pair,
    checked_ratios,
    load_manifest,
    manifest_record,
    package_manifest,
    recipe_from_manifest,
    required_input_columns,
    required_numeric_columns,
)
from tabwright.plans.training import (
    TrainingPaths,
    build_features,
    evaluate_path,
    read_split,
    run_training,
    train_table,
)
from tabwright.sources.artifacts import load_artifact, model_sha256, save_artifact
from tabwright.sources.files import read_json, write_json
from tabwright.sources.tables import read_table, write_table
from tabwright.streaming import score_stream

# --- fixed values -----------------------------------------------------------
# A published five-class confusion matrix (rows are the truth) and its metrics.
LABELS = ["Acquired", "Acquired (Fire Sale)", "Closed", "IPO", "Independent"]
MATRIX = [
    [91, 28, 64, 142, 70],
    [3, 147, 17, 2, 2],
    [137, 258, 115, 167, 86],
    [32, 2, 20, 36, 12],
    [622, 116, 296, 792, 492],
]
GOLDEN = {
    "accuracy": 0.23499599893304882,
    "balanced_accuracy": 0.3611885652472028,
    "precision_weighted": 0.52909590424197,
    "recall_weighted": 0.23499599893304882,
    "f1_weighted": 0.2760094363196098,
}
GOLDEN_MACRO = (0.2738061963994846, 0.3611885652472028, 0.22360018857002145)
# ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def golden_counts(spark):
    rows = [(a, b, MATRIX[i][j]) for i, a in enumerate(LABELS) for j, b in enumerate(LABELS)]
    return spark.createDataFrame(rows, "label string, prediction string, n bigint").coalesce(1)


def test_golden_metrics(golden_counts):
    metrics = metrics_from_counts(golden_counts, LABELS)
    for name, value in GOLDEN.items():
        assert math.isclose(metrics[name], value, rel_tol=1e-14), name
    macro = metrics["classification_report"]["macro avg"]
    for got, value in zip((macro["precision"], macro["recall"], macro["f1-score"]), GOLDEN_MACRO):
        assert math.isclose(got, value, rel_tol=1e-14)
    assert metrics["confusion_matrix"] == MATRIX and metrics["labels"] == LABELS
    assert metrics["classification_report"]["IPO"]["support"] == 102


def test_absent_classes_count_as_zero(spark):
    counts = spark.createDataFrame([("a", "b", 3), ("b", "b", 1)], "label string, prediction string, n bigint")
    report = {r["label"]: r for r in class_report(counts, ["a", "b", "c"]).collect()}
    assert (report["a"]["precision"], report["a"]["recall"], report["a"]["f1"]) == (0.0, 0.0, 0.0)
    assert report["c"]["support"] == 0 and report["b"]["precision"] == 0.25
    total = summary_metrics(class_report(counts, ["a", "b", "c"])).first()
    assert total["balanced_accuracy"] == 0.5 and math.isclose(total["recall_macro"], 1 / 3)
    assert confusion_matrix(counts, ["a", "b", "c"]).count() == 9


def test_log_loss_and_unknown_labels(spark):
    df = spark.createDataFrame([("a", "a", 1.0, 0.0), ("b", "a", 1.0, 0.0), ("a", "b", 0.25, 0.75)], "y string, p string, pa double, pb double")
    m = evaluate_predictions(df, "y", "p", ["a", "b"], F.array("pa", "pb"))
    want = (-math.log(1 - EPSILON) - math.log(EPSILON) - math.log(0.25)) / 3
    assert math.isclose(m["log_loss"], want, rel_tol=1e-12)
    assert math.isclose(log_loss(df.filter("p = 'b'"), F.col("pa")).first()[0], -math.log(0.25))
    with pytest.raises(ValueError, match="not fitted on"):
        evaluate_predictions(df, "y", "p", ["a"], None)


def test_gate(spark):
    metrics = spark.createDataFrame([(0.7,)], "f1_weighted double")
    assert quality_gate(metrics, "f1_weighted", 0.7).first()["decision"] == "approved"
    assert quality_gate(metrics, "f1_weighted", 0.71).first()["passed"] is False
    for bad in (spark.createDataFrame([(1.2,)], "f1_weighted double"), spark.createDataFrame([(float("nan"),)], "f1_weighted double")):
        with pytest.raises(Exception, match="finite"):
            quality_gate(bad, "f1_weighted", 0.5).collect()
    with pytest.raises(ValueError):
        quality_gate(metrics, "log_loss", 0.5)
    with pytest.raises(ValueError):
        quality_gate(metrics, "accuracy", 1.5)


# --- preprocessing ----------------------------------------------------------
def test_preprocessing_constants(spark):
    rows = [(1.0, 7, "b", True), (3.0, 7, "a", False), (None, 7, None, None), (8.0, 7, "a", True), (float("nan"), 7, "b", True)]
    df = spark.createDataFrame(rows, "x double, k int, c string, f boolean")
    plan = fit_preprocessing(df, ["x", "k", "f"], ["c"])
    filled = np.array([1, 3, 3, 8, 3.0])
    assert plan.medians == {"x": 3.0, "k": 7.0, "f": 1.0}
    assert math.isclose(plan.means["x"], filled.mean()) and math.isclose(plan.scales["x"], filled.std())
    assert plan.scales["k"] == 1.0 and plan.modes == {"c": "a"} and plan.categories == {"c": ["a", "b"]}
    from pyspark.ml import PipelineModel

    new = spark.createDataFrame([(None, 7, "zz", None), (1.0, 8, "b", False)], df.schema)
    got = [r["tw_features"].toArray() for r in PipelineModel(plan.transformers(df)).transform(new).collect()]
    assert got[0][3:].tolist() == [0.0, 0.0] and got[1][3:].tolist() == [0.0, 1.0]
    assert math.isclose(got[1][0], (1 - filled.mean()) / filled.std()) and got[1][1] == 1.0
    with pytest.raises(ValueError, match="one-hot"):
        fit_preprocessing(df, [], ["c"], max_width=1)


def test_odd_names_and_values_survive_sql(spark):
    df = spark.createDataFrame([(1.0, "it's"), (2.0, "back\\slash"), (3.0, "it's")], "`a.b``c` double, `x y` string")
    plan = fit_preprocessing(df, ["a.b`c"], ["x y"])
    from pyspark.ml import PipelineModel

    gap = spark.createDataFrame([(None, None)], df.schema)
    v = PipelineModel(plan.transformers(df)).transform(gap).first()["tw_features"].toArray()
    assert v.tolist() == [0.0, 0.0, 1.0]  # median = mean here; the mode is "it's"


def test_class_weights_and_wide_features(spark):
    w = class_weights(spark.createDataFrame([("a", 1), ("b", 3)], "class string, n bigint"))
    assert {r["class"]: r["weight"] for r in w.collect()} == {"a": 2.0, "b": 4 / 6}
    df = spark.range(300).select(F.col("id").cast("string").alias("code"), (F.col("id") % 120).cast("string").alias("many"))
    assert wide_features(df, ["code", "many"]) == {"code": 300}


# --- models -----------------------------------------------------------------
def newton(x, y, w):
    """Minimise sum(w * log loss) + |b|^2 / 2 with a free intercept."""
    x = np.hstack([np.ones((len(x), 1)), x])
    ridge = np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ b))
        b -= np.linalg.solve(x.T @ (x * (w * p * (1 - p))[:, None]) + ridge, x.T @ (w * (p - y)) + ridge @ b)
    return b


@pytest.mark.parametrize("weighting", ["balanced", None])
def test_logistic_regression_objective(spark, weighting):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=120) > 0.7).astype(int)
    df = spark.createDataFrame([(*map(float, a), "yes" if b else "no") for a, b in zip(x, y)], "a double, b double, c double, y string")
    artifact, rows, _ = fit_model(df, TrainSpec("y", class_weight=weighting, tolerance=1e-12))
    w = np.where(y == 1, 120 / (2 * y.sum()), 120 / (2 * (120 - y.sum()))) if weighting else np.ones(120)
    want = newton((x - x.mean(0)) / x.std(0), y, w)
    fitted = artifact.pipeline.stages[-1]
    assert np.allclose([fitted.intercept, *fitted.coefficients.toArray()], want, atol=1e-5)
    assert rows == 120 and artifact.classes == ("no", "yes")


def test_training_errors(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (2.0, None, "b"), (3.0, None, None)], "x double, gone string, y string")
    with pytest.raises(ValueError, match="no values"):
        fit_model(df, TrainSpec("y"))
    with pytest.raises(ValueError, match="two classes"):
        fit_model(df.filter("y = 'a'"), TrainSpec("y"))
    with pytest.raises(ValueError, match="no training row"):
        fit_model(df.filter("y is null"), TrainSpec("y"))
    with pytest.raises(ValueError, match="no feature"):
        fit_model(df.select("y"), TrainSpec("y"))
    with pytest.raises(ValueError):
        TrainSpec("y", model_type="boosting")


def test_random_forest_and_integer_classes(spark):
    df = spark.range(60).select((F.col("id") % 30).cast("double").alias("x"), F.when(F.col("id") % 30 < 10, 2).when(F.col("id") % 30 < 20, 10).otherwise(33).alias("y"))
    artifact, _, _ = fit_model(df, TrainSpec("y", model_type="random_forest", n_estimators=5, max_depth=4, seed=1))
    assert artifact.classes == (2, 10, 33)
    scored = score_table(df, artifact)
    assert scored.probability_columns == ("probability_2", "probability_10", "probability_33")
    assert scored.frame.filter("predicted_y = y").count() > 54


# --- the whole flow ---------------------------------------------------------
RECIPE = FeatureRecipe(
    target_column="status", drop_columns=("company_id",), age_from_year_columns=("founding_year",), reference_year=2026,
    log_columns=("total_funding", "valuation", "revenue"), ratio_features=("funding_per_head=total_funding/headcount",),
)


@pytest.fixture(scope="module")
def trained(spark, companies, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("run"))
    write_table(companies, f"{base}/source.parquet")
    paths = TrainingPaths(
        f"{base}/source.parquet", f"{base}/features.parquet", f"{base}/model",
        f"{base}/training.json", f"{base}/evaluation.json", f"{base}/manifest.json",
    )
    run = run_training(spark, paths, RECIPE, SplitSpec(seed=17), TrainSpec("status"))
    return paths, run


@pytest.fixture(scope="module")
def newcomers(spark):
    rows = [
        ("N001", "Quantum", "Seed", None, 2024, 0.4, 2.0, 0.1, 5),
        ("N002", "Fintech", "Series Z", "High", 2019, 16.0, 65.0, 7.0, 0),
        ("N003", "Health", "Seed", "", 2030, -0.7, 3.2, 0.2, 8),
    ]
    return spark.createDataFrame(
        rows, "company_id string, domain string, funding_stage string, ai_adoption_level string, founding_year bigint, "
        "total_funding double, valuation double, revenue double, headcount bigint",
    )


def test_training_run(spark, trained):
    paths, run = trained
    assert run.features.split_rows == {"train": 16, "validation": 4, "test": 4}
    assert run.training.train_rows == 16 and run.evaluation["evaluated_rows"] == 4
    assert any("1 zero denominators" in w for w in run.features.warnings)
    assert sum(read_split(spark, paths.features, s).count() for s in ("train", "validation", "test")) == 24
    manifest = load_manifest(spark, paths.manifest)
    assert manifest["classes"] == ["Acquired", "Independent"]
    assert set(manifest["test_metrics"]) == {"accuracy", "balanced_accuracy", "f1_weighted"}
    assert read_json(spark, paths.training_metrics)["evaluation_dataset"] == "validation"
    with pytest.raises(FileExistsError):
        run_training(spark, paths, RECIPE, SplitSpec(seed=17), TrainSpec("status"))
    with pytest.raises(ValueError, match="validation and test"):
        run_training(spark, paths, RECIPE, SplitSpec(0.8, 0.0, 0.2), TrainSpec("status"))


def test_inference_run(spark, trained, newcomers, tmp_path):
    paths, _ = trained
    data = str(tmp_path / "new.parquet")
    write_table(newcomers, data)
    done = run_inference(
        spark, data, paths.model, paths.manifest, str(tmp_path / "out.parquet"), features_output=str(tmp_path / "f.parquet")
    )
    out = read_table(spark, done.output)
    assert done.stage == "cleaned" and done.rows == 3 and len(done.warnings) == 3
    assert {"company_id", "predicted_status", "probability_acquired", "probability_independent", "founding_year_age"} <= set(out.columns)
    assert out.filter("abs(probability_acquired + probability_independent - 1) < 1e-9").count() == 3
    again = run_inference(spark, str(tmp_path / "f.parquet"), paths.model, paths.manifest, str(tmp_path / "o2.parquet"))
    assert again.stage == "processed"
    assert as_set(read_table(spark, again.output).select("company_id", "probability_acquired")) == as_set(out.select("company_id", "probability_acquired"))
    with pytest.raises(ValueError, match="input"):
        run_inference(spark, data, paths.model, paths.manifest, data)
    plain = score_path(spark, str(tmp_path / "f.parquet"), paths.model, str(tmp_path / "o3.csv"), include_input=False)
    assert plain.frame.columns == ["source_row", "predicted_status", "probability_acquired", "probability_independent"]


def test_in_memory_scoring(spark, trained, newcomers):
    paths, _ = trained
    resources = load_resources(spark, paths.model, paths.manifest)
    result = score_with_recipe(newcomers, resources)
    assert result.frame.columns == [*newcomers.columns, "predicted_status", "probability_acquired", "probability_independent"]
    rows = {r["company_id"]: r for r in result.frame.collect()}
    alone = score_with_recipe(newcomers.filter("company_id = 'N002'"), resources).frame.first()
    assert alone == rows["N002"]
    keyed = score_with_recipe(newcomers, resources, include_input=False, include_probabilities=False, key_columns=("company_id",))
    assert keyed.frame.columns == ["company_id", "predicted_status"]
    with pytest.raises(ValueError, match="already"):
        score_with_recipe(newcomers, resources, prediction_column="domain")
    with pytest.raises(ValueError, match="blank"):
        score_with_recipe(newcomers, resources, prediction_column=" ")
    with pytest.raises(ValueError):
        score_with_recipe(newcomers.drop("valuation"), resources)
    with pytest.raises(ValueError):
        score_with_recipe(newcomers.drop("company_id"), resources)
    assert score_with_recipe(newcomers.drop("company_id"), resources, ignore_missing_drops=True).frame.count() == 3
    long = probability_table(result.frame, ["company_id"], result.probability_columns, resources.artifact.classes)
    assert long.count() == 6
    assert with_confidence(result.frame, result.probability_columns).filter("confidence >= 0.5").count() == 3
    assert prediction_distribution(result.frame, "predicted_status").agg(F.sum("n")).first()[0] == 3


def test_stream_equals_batch(spark, trained, newcomers, tmp_path):
    paths, _ = trained
    resources = load_resources(spark, paths.model, paths.manifest)
    write_table(newcomers, str(tmp_path / "in.parquet"))
    stream = spark.readStream.schema(newcomers.schema).parquet(str(tmp_path / "in.parquet"))
    running = score_stream(stream, resources, str(tmp_path / "out"), str(tmp_path / "progress"))
    running.awaitTermination()
    batch = score_with_recipe(newcomers, resources).frame
    assert as_set(spark.read.parquet(str(tmp_path / "out"))) == as_set(batch)
    with pytest.raises(ValueError, match="streaming"):
        score_stream(newcomers, resources, "a", "b")


def test_names_of_probability_columns():
    assert probability_names(["A b", "a-B", "??"], {"probability_unknown"}) == ["probability_a_b", "probability_a_b_2", "probability_unknown_2"]


def test_stage_choice():
    assert resolve_stage("auto", ["a", "b"], ["a"]) == "processed"
    assert resolve_stage("auto", ["b"], ["a"]) == "cleaned"
    assert resolve_stage("processed", ["b"], ["a"]) == "processed"
    with pytest.raises(ValueError):
        resolve_stage("raw", [], [])


def test_artifacts(spark, trained, tmp_path):
    paths, run = trained
    artifact = load_artifact(spark, paths.model)
    assert artifact.description() == run.training.artifact.description()
    assert artifact.fitted_categories()["funding_stage"][0] == "Seed"
    with pytest.raises(FileExistsError):
        save_artifact(spark, artifact, paths.model)
    with pytest.raises(FileNotFoundError):
        load_artifact(spark, str(tmp_path / "none"))
    save_artifact(spark, artifact, str(tmp_path / "m"))
    good = read_json(spark, str(tmp_path / "m" / "artifact.json"))
    for change in ({**good, "artifact_version": 2}, {k: v for k, v in good.items() if k != "classes"}):
        write_json(spark, change, str(tmp_path / "m" / "artifact.json"))
        with pytest.raises(ArtifactError):
            load_artifact(spark, str(tmp_path / "m"))
    assert len(model_sha256(spark, paths.model)) == 64
    package = package_manifest(spark, artifact, RECIPE, paths.model, {"a": 1}, {"b": 2})
    assert package["model_sha256"] == model_sha256(spark, paths.model) and package["model_filename"] == "model"


def test_manifest_checks(spark, trained, tmp_path):
    _, run = trained
    artifact = run.training.artifact
    good = manifest_record(artifact, RECIPE, "m")
    check_pair(good, artifact)
    config = good["feature_build_config"]
    for change in (
        {"expected_feature_columns": ["x"]}, {"target_column": "other"}, {"classes": ["Independent", "Acquired"]},
        {"model_type": "random_forest"}, {"random_state": 1}, {"numeric_columns": []},
        {"feature_build_config": {**config, "keep_date_columns": True}},
        {"feature_build_config": {**config, "drop_columns": "company_id"}},
        {"feature_build_config": {**config, "log_columns": ["a", "a"]}},
        {"feature_build_config": {**config, "reference_year": "2026"}},
        {"feature_build_config": {k: v for k, v in config.items() if k != "log_columns"}},
    ):
        with pytest.raises(ArtifactError):
            check_pair({**good, **change}, artifact)
    for bad in ("r=a/b", ["r=a/b=c"], ["r=a/b", "r=c/d"], [1]):
        with pytest.raises(ArtifactError):
            checked_ratios(bad)
    assert recipe_from_manifest(good).log_columns == RECIPE.log_columns
    needed = required_input_columns(good, ["headcount"])
    assert needed[0] == "headcount" and "company_id" in needed and "status" not in needed
    assert not set(needed) & set(RECIPE.generated_names())
    assert required_numeric_columns(good) == {"founding_year", "total_funding", "valuation", "revenue", "headcount"}
    write_json(spark, {**good, "manifest_version": 2}, str(tmp_path / "m.json"))
    with pytest.raises(ArtifactError):
        load_manifest(spark, str(tmp_path / "m.json"))


def test_evaluation_and_training_without_validation(spark, trained, companies, tmp_path):
    paths, run = trained
    test_rows = str(tmp_path / "test.parquet")
    rows = read_split(spark, paths.features, "test")
    gap = rows.limit(1).withColumn("status", F.lit(None).cast("string"))
    write_table(rows.unionByName(gap), test_rows)
    result = evaluate_path(spark, test_rows, paths.model, str(tmp_path / "r.json"))
    assert (result["evaluated_rows"], result["dropped_target_rows"]) == (4, 1)
    assert result["metrics"]["accuracy"] == run.evaluation["metrics"]["accuracy"]
    done = train_table(rows, None, TrainSpec("status", max_iter=20))
    assert done.evaluation_dataset == "training" and done.warnings


def test_unsplit_features(spark, companies, tmp_path):
    write_table(companies.drop("status"), str(tmp_path / "s.parquet"))
    recipe = FeatureRecipe(log_columns=("revenue",))
    built = build_features(spark, str(tmp_path / "s.parquet"), str(tmp_path / "f.csv"), recipe, None)
    assert built.split_rows == {} and read_table(spark, built.path).count() == 24
    assert read_json(spark, str(tmp_path / "f.csv.metadata.json"))["engineered_features"] == ["revenue_log1p"]


def test_resources_pair_type(trained):
    _, run = trained
    assert isinstance(Resources(run.training.artifact, run.manifest), Resources)


def test_scoring_after_an_observation(spark, companies):
    """A fitted model must not drag the session into its tasks."""
    from pyspark.sql import Observation

    seen = Observation("any")
    companies.observe(seen, F.count("*").alias("n")).count()
    assert seen.get["n"] == 24
    for kind in ("logistic_regression", "random_forest"):
        spec = TrainSpec("status", model_type=kind, n_estimators=3, max_depth=3, max_iter=5)
        artifact, _, _ = fit_model(companies.drop("company_id"), spec)
        assert score_table(companies, artifact).frame.count() == 24

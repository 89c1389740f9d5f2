"""Model fitting, scoring and streaming on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators.features import FeatureRecipe, feature_table
from tabwright.operators.preprocess import class_weights
from tabwright.operators.quantiles import exact_medians
from tabwright.operators.score import probability_names, probability_table, score_table
from tabwright.operators.split import SplitSpec, class_counts
from tabwright.operators.train import TrainSpec, fit_model
from tabwright.plans.inference import (
    Resources,
    inference_features,
    load_resources,
    run_inference,
    score_path,
    score_with_recipe,
)
from tabwright.plans.manifest import manifest_record, save_manifest
from tabwright.plans.training import TrainingPaths, evaluate_path, run_training, train_table
from tabwright.session import scratch_path, small_table
from tabwright.sources.artifacts import save_artifact
from tabwright.sources.tables import read_table, write_table
from tabwright.streaming import score_stream
from tabwright.workloads.registry import SALES_CTE, query, sales, table

RECIPE = FeatureRecipe(
    target_column="o_orderstatus",
    drop_columns=("o_orderkey", "n_regionkey"),
    date_columns=("o_orderdate",),
    age_from_year_columns=("order_year",),
    reference_year=2026,
    log_columns=("o_totalprice",),
    ratio_features=("price_to_balance=o_totalprice/c_acctbal",),
)
SPLIT = SplitSpec(seed=17)
METRICS = ("accuracy", "balanced_accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "log_loss")


def _trained(spark, sf_dir):
    """A whole training run: features, model, evaluation and manifest in the shared folder."""
    base = scratch_path(spark, "training")
    write_table(sales(spark, sf_dir), f"{base}/sales.parquet")
    paths = TrainingPaths(
        f"{base}/sales.parquet", f"{base}/features.parquet", f"{base}/model",
        f"{base}/training.json", f"{base}/evaluation.json", f"{base}/manifest.json",
    )
    run = run_training(spark, paths, RECIPE, SPLIT, TrainSpec("o_orderstatus"))
    return paths, run


def metric_rows(spark, blocks):
    rows = [
        (name, metric, float(block["metrics"][metric]))
        for name, block in blocks.items()
        for metric in METRICS
    ]
    return small_table(spark, rows, "dataset string, metric string, value double")


@query("training_pipeline")
def training_pipeline(spark, sf_dir):
    _, run = _trained(spark, sf_dir)
    return metric_rows(spark, {"validation": run.training.metrics, "test": run.evaluation})


@query(
    "training_pipeline_splits",
    """WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus)
    SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS dropped FROM c""",
)
def training_pipeline_splits(spark, sf_dir):
    paths, run = _trained(spark, sf_dir)
    stored = read_table(spark, paths.features)
    return stored.agg(F.count("*").alias("rows")).withColumn(
        "dropped", F.lit(run.features.dropped_target_rows).cast("bigint")
    )


def _features(spark, sf_dir):
    items = table(spark, sf_dir, "orders")
    return items.select("o_totalprice", "o_orderstatus", "o_orderpriority")


@query("train_lr_metrics")
def train_lr_metrics(spark, sf_dir):
    done = train_table(_features(spark, sf_dir), None, TrainSpec("o_orderpriority"))
    return metric_rows(spark, {done.evaluation_dataset: done.metrics})


@query("train_rf_metrics")
def train_rf_metrics(spark, sf_dir):
    spec = TrainSpec("o_orderstatus", model_type="random_forest")
    done = train_table(_features(spark, sf_dir), None, spec)
    return metric_rows(spark, {done.evaluation_dataset: done.metrics})


#: The model of the scoring queries sees one category and has no penalty or weights, so
#: its probabilities are the class shares of each category, which SQL counts.
PLAIN = dict(class_weight=None, inverse_regularization=1e9, tolerance=1e-12)
SHARES_SQL = """
  counts AS (SELECT o_orderpriority AS g, o_orderstatus AS c, count(*) AS n FROM orders GROUP BY ALL),
  shares AS (SELECT g, sum(n) AS n, coalesce(sum(n) FILTER (c = 'F'), 0) / sum(n) AS f,
    coalesce(sum(n) FILTER (c = 'O'), 0) / sum(n) AS o, coalesce(sum(n) FILTER (c = 'P'), 0) / sum(n) AS p
    FROM counts GROUP BY g),
  labelled AS (SELECT *, CASE WHEN f >= o AND f >= p THEN 'F' WHEN o >= p THEN 'O' ELSE 'P' END AS label FROM shares)"""
SCORES_SQL = f"""WITH {SHARES_SQL}
  SELECT o_orderkey, label AS predicted, round(f, 3) AS share_f, round(o, 3) AS share_o, round(p, 3) AS share_p
  FROM orders JOIN labelled ON o_orderpriority = g"""
PLAIN_RECIPE = FeatureRecipe(target_column="o_orderstatus", drop_columns=("o_orderkey",))


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")


def _stored_model(spark, sf_dir):
    """(model path, manifest path) of the plain model, fitted and written anew."""
    base = scratch_path(spark, "plain")
    rows = _orders(spark, sf_dir).drop("o_orderkey")
    artifact, _, _ = fit_model(rows, TrainSpec("o_orderstatus", **PLAIN))
    save_artifact(spark, artifact, f"{base}/model")
    save_manifest(spark, manifest_record(artifact, PLAIN_RECIPE, f"{base}/model"), f"{base}/manifest.json")
    return f"{base}/model", f"{base}/manifest.json"


def _shares(frame, prediction, probabilities, classes, *keys):
    """Keys, predicted label and the probabilities of F, O and P."""
    by_class = dict(zip(classes, probabilities))
    return frame.select(
        *keys,
        F.col(prediction).alias("predicted"),
        *[
            F.round(F.col(by_class[c]) if c in by_class else F.lit(0.0), 3).alias(f"share_{c.lower()}")
            for c in ("F", "O", "P")
        ],
    )


@query("score_rows", SCORES_SQL)
def score_rows(spark, sf_dir):
    """In-memory scoring of cleaned rows with a stored model."""
    resources = load_resources(spark, *_stored_model(spark, sf_dir))
    result = score_with_recipe(_orders(spark, sf_dir), resources)
    return _shares(
        result.frame, result.prediction_column, result.probability_columns,
        resources.artifact.classes, "o_orderkey",
    )


@query(
    "score_known_rows",
    f"""WITH {SHARES_SQL} SELECT o_orderkey, o_orderstatus, o_orderpriority, label AS predicted,
    label = o_orderstatus AS hit FROM orders JOIN labelled ON o_orderpriority = g""",
)
def score_known_rows(spark, sf_dir):
    """Every input row comes back with its own columns and the predicted label."""
    resources = load_resources(spark, *_stored_model(spark, sf_dir))
    result = score_with_recipe(_orders(spark, sf_dir), resources)
    predicted = F.col(result.prediction_column)
    return result.frame.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", predicted.alias("predicted"),
        (predicted == F.col("o_orderstatus")).alias("hit"),
    )


@query(
    "score_source_rows",
    "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS first_row, CAST(count(*) - 1 AS BIGINT) AS last_row, CAST(count(*) AS BIGINT) AS distinct_rows FROM orders",
)
def score_source_rows(spark, sf_dir):
    """Output without input columns is numbered 0, 1, 2, … without gaps."""
    resources = load_resources(spark, *_stored_model(spark, sf_dir))
    result = score_with_recipe(_orders(spark, sf_dir), resources, include_input=False, from_files=True)
    return result.frame.agg(
        F.count("*").alias("rows"),
        F.min("source_row").alias("first_row"),
        F.max("source_row").alias("last_row"),
        F.countDistinct("source_row").alias("distinct_rows"),
    )


@query("score_stage_auto", SCORES_SQL)
def score_stage_auto(spark, sf_dir):
    """File pipeline; the stage is found from the columns."""
    model, manifest = _stored_model(spark, sf_dir)
    base = scratch_path(spark, "stage")
    write_table(_orders(spark, sf_dir), f"{base}/orders.parquet")
    done = run_inference(spark, f"{base}/orders.parquet", model, manifest, f"{base}/predictions.parquet")
    classes = load_resources(spark, model, manifest).artifact.classes
    return _shares(
        read_table(spark, done.output), done.prediction_column, done.probability_columns,
        classes, "o_orderkey",
    )


@query(
    "evaluate_model",
    f"""WITH {SHARES_SQL},
  scored AS (SELECT o_orderstatus AS c, label, CASE o_orderstatus WHEN 'F' THEN f WHEN 'O' THEN o ELSE p END AS own
    FROM orders JOIN labelled ON o_orderpriority = g WHERE o_orderkey % 10 <> 3)
  SELECT CAST(count(*) AS BIGINT) AS evaluated_rows,
    CAST((SELECT count(*) FROM orders WHERE o_orderkey % 10 = 3) AS BIGINT) AS dropped_target_rows,
    round(avg((c = label)::INT), 6) AS accuracy, round(-avg(ln(own)), 3) AS log_loss,
    CAST(sum((c = label)::INT) AS BIGINT) AS diagonal FROM scored""",
)
def evaluate_model(spark, sf_dir):
    """The stored model on stored features, some rows without a target."""
    model, _ = _stored_model(spark, sf_dir)
    target = F.when(F.col("o_orderkey") % 10 != 3, F.col("o_orderstatus"))
    base = scratch_path(spark, "evaluation")
    rows = _orders(spark, sf_dir).withColumn("o_orderstatus", target).drop("o_orderkey")
    write_table(rows, f"{base}/rows.parquet")
    done = evaluate_path(spark, f"{base}/rows.parquet", model, f"{base}/report.json")
    metrics = done["metrics"]
    row = (
        done["evaluated_rows"], done["dropped_target_rows"], round(metrics["accuracy"], 6),
        round(metrics["log_loss"], 3), sum(r[i] for i, r in enumerate(metrics["confusion_matrix"])),
    )
    return small_table(
        spark,
        [row],
        "evaluated_rows bigint, dropped_target_rows bigint, accuracy double, log_loss double, diagonal bigint",
    )


@query(
    "train_lr_optimum",
    """SELECT o_orderpriority AS class, round(1.0::DOUBLE / count(*) OVER (), 3) AS weighted_share
    FROM orders GROUP BY o_orderpriority""",
)
def train_lr_optimum(spark, sf_dir):
    """At the optimum the gradient of every free intercept is zero: with balanced
    weights the weighted mean probability of each of k classes is 1/k."""
    rows = _features(spark, sf_dir)
    artifact, total, _ = fit_model(rows, TrainSpec("o_orderpriority", tolerance=1e-9))
    scored = score_table(rows, artifact)
    weights = class_weights(class_counts(rows, "o_orderpriority"))
    weighted = scored.frame.join(
        F.broadcast(weights), F.col("o_orderpriority") == F.col("class")
    ).drop("class")
    long = probability_table(weighted, ["weight"], scored.probability_columns, artifact.classes)
    return long.groupBy("class").agg(
        F.round(F.sum(F.col("weight") * F.col("probability")) / total, 3).alias("weighted_share")
    )


@query("score_file", SCORES_SQL)
def score_file(spark, sf_dir):
    """A stored feature table scored with a stored model into a stored table."""
    model, manifest = _stored_model(spark, sf_dir)
    resources = load_resources(spark, model, manifest)
    frame, _ = inference_features(_orders(spark, sf_dir), resources.manifest)
    base = scratch_path(spark, "scoring")
    write_table(frame, f"{base}/features.parquet")
    result = score_path(spark, f"{base}/features.parquet", model, f"{base}/scored.parquet")
    return _shares(
        read_table(spark, f"{base}/scored.parquet"), result.prediction_column,
        result.probability_columns, resources.artifact.classes, "o_orderkey",
    )


@query(
    "stream_score",
    """WITH m AS (SELECT median(value) AS middle FROM events),
  shares AS (SELECT event_type AS g, avg((value > middle)::INT) AS high FROM events, m GROUP BY event_type)
  SELECT event_id, event_type, round(high, 3) AS share_high,
    CASE WHEN high >= 0.5 THEN 'high' ELSE 'low' END AS predicted
  FROM events JOIN shares ON event_type = g""",
)
def stream_score(spark, sf_dir):
    """Fit on the events, then score them again as a stream."""
    events = table(spark, sf_dir, "events")
    recipe = FeatureRecipe(
        target_column="kind", drop_columns=tuple(c for c in events.columns if c != "event_type")
    )
    median = exact_medians(events, ["value"])["value"]
    labelled = events.withColumn("kind", F.when(F.col("value") > median, "high").otherwise("low"))
    artifact, _, _ = fit_model(feature_table(labelled, recipe), TrainSpec("kind", **PLAIN))
    resources = Resources(artifact, manifest_record(artifact, recipe, "in memory"))
    base = scratch_path(spark, "stream")
    stream = (
        spark.readStream.schema(events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    running = score_stream(stream, resources, f"{base}/scored", f"{base}/progress")
    running.awaitTermination()
    scored = spark.read.parquet(f"{base}/scored")
    names = probability_names(artifact.classes, scored.columns[: len(events.columns)])
    high = dict(zip(artifact.classes, names))["high"]
    return scored.select(
        "event_id", "event_type", F.round(high, 3).alias("share_high"),
        F.col("predicted_kind").alias("predicted"),
    )

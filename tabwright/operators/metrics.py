"""Classification metrics from one (label, prediction) count table.

The table is grouped once with partial aggregation; everything but log loss is
arithmetic over at most classes x classes rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.schema import quoted
from tabwright.session import settle_any, small_table

# --- fixed values -----------------------------------------------------------
# Probabilities are clipped to [EPSILON, 1 - EPSILON], the double machine epsilon.
EPSILON = 2.220446049250313e-16
#: Most classes whose confusion matrix is returned dense and whose labels are literals in a plan.
DENSE_CLASSES = 1_000
#: Unknown labels that an error names; it counts the rest.
NAMED = 100
# Metrics a quality gate may use.
GATE_METRICS = ("accuracy", "balanced_accuracy", "f1_weighted")
# ----------------------------------------------------------------------------


def prediction_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n)."""
    return df.groupBy(
        quoted(label).alias("label"), quoted(prediction).alias("prediction")
    ).agg(F.count("*").alias("n"))


def class_table(spark, classes) -> DataFrame:
    """(position, label) for the fitted classes in order."""
    kind = "string"
    if classes and all(isinstance(c, bool) for c in classes):
        kind = "boolean"
    elif classes and all(isinstance(c, int) for c in classes):
        kind = "bigint"
    elif classes and all(isinstance(c, float) for c in classes):
        kind = "double"
    return small_table(spark, list(enumerate(classes)), f"position bigint, label {kind}")


def unknown_labels(counts: DataFrame, classes) -> DataFrame:
    """Labels in the truth that are not among ``classes``."""
    return (
        counts.filter(~F.col("label").isin(list(classes)))
        .groupBy("label")
        .agg(F.sum("n").alias("n"))
    )


def confusion_matrix(counts: DataFrame, classes) -> DataFrame:
    """(label, prediction, n) for every pair of classes, zeros included."""
    table = class_table(counts.sparkSession, classes)
    pairs = table.select(
        F.col("label"), F.explode(F.array(*[F.lit(c) for c in classes])).alias("prediction")
    )
    return (
        pairs.join(counts, ["label", "prediction"], "left")
        .select("label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    )


def class_report(counts: DataFrame, classes) -> DataFrame:
    """(label, precision, recall, f1, support, predicted, hits); 0/0 is 0."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)

    def side(name, support, predicted, hits):
        return F.struct(
            F.col(name).alias("label"),
            support.alias("support"),
            predicted.alias("predicted"),
            hits.alias("hits"),
        )

    # each cell counts once for its true and once for its predicted class
    sides = F.array(
        side("label", F.col("n"), zero, hit), side("prediction", zero, F.col("n"), zero)
    )
    sums = (
        counts.select(F.inline(sides))
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    table = class_table(counts.sparkSession, classes)
    merged = table.join(sums, "label", "left").select(
        "position",
        "label",
        *[F.coalesce(c, zero).alias(c) for c in ("support", "predicted", "hits")],
    )

    def share(top, bottom):
        return F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom)), F.lit(0.0))

    return merged.select(
        "position",
        "label",
        share("hits", "predicted").alias("precision"),
        share("hits", "support").alias("recall"),
        F.coalesce(
            F.try_divide(2.0 * F.col("hits"), F.col("support") + F.col("predicted")), F.lit(0.0)
        ).alias("f1"),
        "support",
        "predicted",
        "hits",
    )


def summary_metrics(report: DataFrame) -> DataFrame:
    """One row of headline, weighted and macro metrics from :func:`class_report`."""
    total = F.sum("support")

    def weighted(name):
        return F.coalesce(F.try_divide(F.sum(F.col(name) * F.col("support")), total), F.lit(0.0))

    return report.agg(
        F.coalesce(F.try_divide(F.sum("hits").cast("double"), total), F.lit(0.0)).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        weighted("precision").alias("precision_weighted"),
        weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        total.alias("support"),
    )


def log_loss(df: DataFrame, true_probability) -> DataFrame:
    """One row ``log_loss``: mean of -ln(p) for the probability of the true class."""
    p = F.greatest(F.least(true_probability, F.lit(1.0 - EPSILON)), F.lit(EPSILON))
    return df.agg(F.avg(-F.log(p)).alias("log_loss"))


def true_class_probability(label, classes, probabilities):
    """Element of the ``probabilities`` array that belongs to the row's label."""
    order = F.array(*[F.lit(c) for c in classes])
    return F.get(probabilities, F.array_position(order, label).cast("int") - 1)


def evaluate_predictions(df, label, prediction, classes, probabilities=None) -> dict:
    """Metrics of scored rows as a plain dict; one pass over ``df``.

    With probabilities the log loss is summed inside the same grouping.
    """
    extra = []
    if probabilities is not None:
        p = true_class_probability(quoted(label), classes, probabilities)
        p = F.greatest(F.least(p, F.lit(1.0 - EPSILON)), F.lit(EPSILON))
        extra = [F.sum(-F.log(p)).alias("loss")]
    counts = df.groupBy(
        quoted(label).alias("label"), quoted(prediction).alias("prediction")
    ).agg(F.count("*").alias("n"), *extra)
    counts, _ = settle_any(counts)
    if len(classes) <= DENSE_CLASSES:
        strange = counts.filter(F.col("label").isNull() | ~F.col("label").isin(list(classes)))
    else:
        strange = counts.join(class_table(df.sparkSession, classes), "label", "left_anti")
    strange = strange.select(F.col("label").cast("string").alias("label")).distinct()
    found = strange.count()
    if found:
        named = [str(r["label"]) for r in strange.orderBy("label").limit(NAMED).collect()]
        rest = f" and {found - NAMED} more" if found > NAMED else ""
        raise ValueError(f"labels the model was not fitted on: {sorted(named)}{rest}")
    return metrics_from_counts(counts, classes)


def metrics_from_counts(counts: DataFrame, classes) -> dict:
    """The full metric block from a (label, prediction, n[, loss]) table.

    Up to ``DENSE_CLASSES`` classes it holds the dense confusion matrix. For more classes it
    has ``confusion_cells`` instead, the number of pairs that occur; ``counts`` itself is the
    sparse matrix and never comes to the driver.
    """
    classes = list(classes)
    report = class_report(counts, classes)
    per_class = sorted(report.collect(), key=lambda r: r["position"])
    fixed = small_table(counts.sparkSession, [tuple(r) for r in per_class], report.schema)
    total = summary_metrics(fixed).first().asDict()
    metrics = {
        k: total[k]
        for k in (
            "accuracy", "balanced_accuracy", "precision_weighted", "recall_weighted", "f1_weighted",
        )
    }
    metrics["labels"] = classes
    if len(classes) <= DENSE_CLASSES:
        cells = {(r["label"], r["prediction"]): r["n"] for r in counts.collect()}
        metrics["confusion_matrix"] = [[cells.get((a, b), 0) for b in classes] for a in classes]
    else:
        metrics["confusion_cells"] = counts.filter("n > 0").count()

    def block(precision, recall, f1, support):
        return {"precision": precision, "recall": recall, "f1-score": f1, "support": support}

    details = {
        str(r["label"]): block(r["precision"], r["recall"], r["f1"], r["support"]) for r in per_class
    }
    details["accuracy"] = total["accuracy"]
    details["macro avg"] = block(
        total["precision_macro"], total["recall_macro"], total["f1_macro"], total["support"]
    )
    details["weighted avg"] = block(
        total["precision_weighted"], total["recall_weighted"], total["f1_weighted"], total["support"]
    )
    metrics["classification_report"] = details
    if "loss" in counts.columns:
        loss, n = counts.agg(F.sum("loss"), F.sum("n")).first()
        metrics["log_loss"] = loss / n if n else None
    return metrics


def quality_gate(metrics: DataFrame, metric: str, minimum: float) -> DataFrame:
    """(metric_name, metric_value, minimum_value, passed, decision) per metrics row.

    A rejection is a normal result; values outside [0, 1] are errors.
    """
    if metric not in GATE_METRICS:
        raise ValueError(f"gate metric must be one of {list(GATE_METRICS)}")
    minimum = float(minimum)
    if not 0.0 <= minimum <= 1.0:
        raise ValueError("the gate minimum must lie between 0 and 1")
    value = quoted(metric).cast("double")
    sound = value.isNotNull() & ~F.isnan(value) & value.between(0.0, 1.0)
    checked = F.when(sound, value).otherwise(
        F.raise_error(F.lit(f"{metric} must be a finite number between 0 and 1")).cast("double")
    )
    passed = F.col("metric_value") >= F.col("minimum_value")
    return (
        metrics.select(
            F.lit(metric).alias("metric_name"),
            checked.alias("metric_value"),
            F.lit(minimum).alias("minimum_value"),
        )
        .withColumn("passed", passed)
        .withColumn("decision", F.when(passed, "approved").otherwise("rejected"))
    )

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_models import RECIPE

from tabwright.operators import metrics, split
from tabwright.operators.gram import blocked_correlations
from tabwright.operators.metrics import class_report, metrics_from_counts
from tabwright.operators.profile import correlations
from tabwright.operators.rownum import number_scan_rows
from tabwright.operators.split import SplitSpec, split_table
from tabwright.operators.train import TrainSpec
from tabwright.plans import training
from tabwright.plans.inference import load_resources
from tabwright.plans.training import TrainingPaths, run_training
from tabwright.sources import publish
from tabwright.sources.files import exists, read_json
from tabwright.sources.tables import write_table


# --- row numbers ------------------------------------------------------------
@pytest.mark.parametrize("suffix", ["parquet", "csv", "json"])
def test_scan_rows_follow_the_files(spark, tmp_path, suffix):
    path = f"{tmp_path}/t.{suffix}"
    spark.range(5000, numPartitions=7).select("id", F.lit("x").alias("v")).write.format(suffix).options(header=True).save(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        read = spark.read.format(suffix).schema("id long, v string").options(header=True).load(path)
        got = number_scan_rows(read.filter("id % 2 = 0"), "n", 1)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "ExistingRDD" not in plan  # nothing was written
        rows = sorted((r.n, r.id) for r in got.collect())
        assert rows == [(i + 1, 2 * i) for i in range(2500)]
        assert number_scan_rows(read, "n").filter("v = 'x' and n != id").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert number_scan_rows(read.limit(0), "n").count() == 0
    shuffled = spark.range(100).repartition(3)  # no files: numbered by way of a checkpoint
    assert sorted(r.n for r in number_scan_rows(shuffled, "n").collect()) == list(range(100))
    with pytest.raises(ValueError):
        number_scan_rows(read, "v")


# --- correlations -----------------------------------------------------------
def test_blocked_correlations_equal_the_expressions(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 9)) @ rng.standard_normal((9, 9)) + 1e6
    rows = [[None if (i + j) % (j + 5) == 0 and j % 2 else float(v) for j, v in enumerate(r)] for i, r in enumerate(x)]
    for i, r in enumerate(rows):
        r += [5.0, None, float(i) if i < 2 else None, float("inf") if i == 7 else float(i)]
    names = [f"c{i}" for i in range(13)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5)
    a = {(r.left, r.right): r.correlation for r in correlations(df, names).collect()}
    b = {(r.left, r.right): r.correlation for r in blocked_correlations(df, names).collect()}
    assert set(a) == set(b)
    for key, value in a.items():
        assert (value is None) == (b[key] is None), key
        assert value is None or abs(value - b[key]) < 1e-9
    assert blocked_correlations(df.limit(0), names).filter("correlation is not null").count() == 0


def test_500_columns(spark):
    wide = spark.range(2000).select(*[((F.col("id") * (i + 3)) % (101 + i)).cast("double").alias(f"c{i}") for i in range(500)])
    got = correlations(wide, wide.columns)
    assert got.count() == 250_000
    some = {(r.left, r.right): r.correlation for r in got.filter("left = 'c3'").collect()}
    x = np.array([[(i * (k + 3)) % (101 + k) for k in range(500)] for i in range(2000)], float)
    want = np.corrcoef(x.T)[3]
    assert all(abs(some["c3", f"c{k}"] - want[k]) < 1e-9 for k in range(500))


# --- many classes -----------------------------------------------------------
def test_split_with_a_class_for_every_ten_rows(spark, monkeypatch):
    monkeypatch.setattr(split, "BROADCAST_CLASSES", 100)
    rows = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.floor(F.col("id") / 10)).cast("string").alias("kind")
    )
    sizes = {r.kind: r["count"] for r in rows.groupBy("kind").count().collect()}
    assert len(sizes) == 3001 and sizes["-1"] == 10_000
    spec = SplitSpec(target_column="kind", key_columns=("id",), most_classes=10_000, fallback="error")
    result = split_table(rows, spec)
    got = {(r.kind, r.split): r["count"] for r in result.frame.groupBy("kind", "split").count().collect()}
    quotas = {r["class"]: r for r in result.quotas.collect()}
    assert sum(got.values()) == 30_000
    for kind in sizes:
        for part in ("train", "validation", "test"):
            assert got.get((kind, part), 0) == quotas[kind][part], (kind, part)
    monkeypatch.undo()
    same = split_table(rows, spec).frame
    assert same.exceptAll(result.frame).count() == 0


def test_metrics_of_20000_classes_stay_sparse(spark):
    n = 20_000
    pairs = spark.range(n).select(
        F.col("id").alias("label"), F.when(F.col("id") % 4 == 0, F.col("id") + 1).otherwise(F.col("id")).alias("prediction"),
        F.lit(2).cast("long").alias("n"),
    )
    block = metrics_from_counts(pairs, range(n + 1))
    assert "confusion_matrix" not in block and block["confusion_cells"] == n
    assert block["accuracy"] == 0.75 and len(block["classification_report"]) == n + 4
    assert abs(block["balanced_accuracy"] - 0.75) < 1e-12
    # one and the same figures where both forms are possible
    small = pairs.filter("label < 40")
    dense = metrics_from_counts(small, range(41))
    assert len(dense["confusion_matrix"]) == 41
    report = class_report(small, range(41))
    assert sum(r.hits for r in report.collect()) == sum(r[i] for i, r in enumerate(dense["confusion_matrix"]))


def test_unknown_labels_of_many_classes(spark, monkeypatch):
    monkeypatch.setattr(metrics, "DENSE_CLASSES", 2)
    df = spark.createDataFrame([("a", "a"), ("b", "c"), ("x", "a")], "label string, p string")
    with pytest.raises(ValueError, match="'x'"):
        metrics.evaluate_predictions(df, "label", "p", ["a", "b", "c"])
    block = metrics.evaluate_predictions(df.filter("label != 'x'"), "label", "p", ["a", "b", "c"])
    assert block["accuracy"] == 0.5 and block["confusion_cells"] == 2


# --- publication ------------------------------------------------------------
def test_a_stopped_run_leaves_the_old_pair(spark, companies, tmp_path, monkeypatch):
    base = str(tmp_path)
    write_table(companies, f"{base}/source.parquet")
    paths = TrainingPaths(
        f"{base}/source.parquet", f"{base}/features.parquet", f"{base}/model",
        f"{base}/training.json", f"{base}/evaluation.json", f"{base}/manifest.json",
    )
    run_training(spark, paths, RECIPE, SplitSpec(seed=17), TrainSpec("status", max_iter=5))
    old = read_json(spark, f"{base}/model/artifact.json")
    assert not exists(spark, publish.staged(paths.model))

    def stop(*args):
        raise KeyboardInterrupt

    again = dict(overwrite=True)
    with monkeypatch.context() as m:  # between model and manifest
        m.setattr(training, "save_manifest", stop)
        with pytest.raises(KeyboardInterrupt):
            run_training(spark, paths, RECIPE, SplitSpec(seed=17), TrainSpec("status", max_iter=5, seed=5), **again)
    assert load_resources(spark, paths.model, paths.manifest).artifact.random_state == 42
    assert read_json(spark, f"{base}/model/artifact.json") == old
    moved = []
    with monkeypatch.context() as m:  # after the commit record, with one output moved
        finish = publish.finish

        def half(spark, anchor):
            record = read_json(spark, publish.record_path(anchor))["paths"]
            place, fs = publish._path(spark, record[0])
            fs.delete(place, True)
            fs.rename(publish._path(spark, publish.staged(record[0]))[0], place)
            moved.append(record[0])
            raise KeyboardInterrupt

        m.setattr(publish, "finish", half)
        with pytest.raises(KeyboardInterrupt):
            run_training(spark, paths, RECIPE, SplitSpec(seed=17), TrainSpec("status", max_iter=5, seed=6), **again)
        assert finish is not half
    assert moved and exists(spark, publish.record_path(paths.manifest))
    pair = load_resources(spark, paths.model, paths.manifest)  # the reader finishes the commit
    assert pair.artifact.random_state == 6 and pair.manifest["random_state"] == 6
    assert not exists(spark, publish.record_path(paths.manifest))
    with pytest.raises(FileNotFoundError):
        publish.publish(spark, paths.manifest, [paths.model])

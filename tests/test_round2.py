"""Rules that earlier results broke: split quotas, lossless reading, manifests, limits."""

import pytest
from pyspark.sql import functions as F

from tabwright.errors import ArtifactError
from tabwright.operators.metrics import evaluate_predictions
from tabwright.operators.profile import ProfileSpec, choose_columns
from tabwright.operators.score import probability_names
from tabwright.operators.split import SplitSpec, split_table
from tabwright.operators.train import TrainSpec
from tabwright.plans.manifest import RECIPE_RULES, Rule, checked_ratios, require_rules
from tabwright.sources.tables import csv_ragged_counts, raw_csv, read_table
from tabwright.sources.zones import snapshot
from tabwright.workloads import training

HALF = SplitSpec(0.5, 0.25, 0.25)


def sizes(result):
    got = {r["split"]: r["count"] for r in result.frame.groupBy("split").count().collect()}
    quotas = result.quotas.agg(*[F.sum(s).alias(s) for s in ("train", "validation", "test")]).first()
    return got, {s: n for s, n in quotas.asDict().items() if n}


@pytest.mark.parametrize("parts", [1, 16])
def test_missing_values_that_change_places(spark, parts):
    rows = [("x", None), (None, "x")] * 5
    result = split_table(spark.createDataFrame(rows, "a string, b string").repartition(parts), HALF)
    got, quotas = sizes(result)
    assert got == quotas == {"train": 5, "validation": 3, "test": 2}


def test_keys_with_bars_and_membership(spark):
    rows = [("a|b", "c", i) for i in range(3)] + [("a", "b|c", i) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, l string, i int")
    spec = SplitSpec(0.5, 0.25, 0.25, key_columns=("k", "l"))
    seen = []
    for parts in (1, 16):
        result = split_table(df.repartition(parts), spec)
        got, quotas = sizes(result)
        assert got == quotas
        seen.append(sorted(map(tuple, result.frame.collect())))
    assert seen[0] == seen[1]


def test_impossible_classes(spark):
    df = spark.createDataFrame([(str(i),) for i in range(10)], "c string")
    with pytest.raises(ValueError):
        split_table(df, SplitSpec(target_column="c", fallback="error"))
    assert split_table(df, SplitSpec(target_column="c")).warning
    with pytest.raises(ValueError):
        SplitSpec(fallback="guess")


def put(path, text):
    path.write_text(text)
    return str(path)


def test_ragged_records(spark, tmp_path):
    path = put(tmp_path / "r.csv", 'a,b\n1,2\n3,4,5\n6\n7,8,\n"x,y","q""r"\n')
    with pytest.raises(Exception, match="more than 2 cells"):
        raw_csv(spark, path).collect()
    kept = [tuple(r) for r in raw_csv(spark, path, ragged="drop").collect()]
    assert kept == [("1", "2"), ("6", None), ("x,y", 'q"r')]
    assert tuple(csv_ragged_counts(spark, path).first()) == (5, 1, 2)
    assert raw_csv(spark, path, ragged="drop").select("b").count() == 3


def test_quoted_line_breaks_are_never_misread(spark, tmp_path):
    path = put(tmp_path / "m.csv", 'a,b\n1,"two\nlines"\n3,4\n')
    with pytest.raises(Exception, match="multiline=True"):
        read_table(spark, path).collect()
    rows = [tuple(r) for r in raw_csv(spark, path, multiline=True).collect()]
    assert rows == [("1", "two\nlines"), ("3", "4")]
    one = put(tmp_path / "one.csv", 'a\n"two\nlines"\n')
    assert [tuple(r) for r in raw_csv(spark, one).collect()] == [("two\nlines",)]


def test_files_with_other_header_order(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    put(folder / "1.csv", "a,b\n1,2\n")
    put(folder / "2.csv", "b,a\n9,8\n")
    with pytest.raises(Exception):
        raw_csv(spark, str(folder)).collect()


def test_json_documents(spark, tmp_path):
    array = put(tmp_path / "a.json", '[\n  {"x": 1, "y": "p"},\n  {"x": 2, "y": null}\n]\n')
    assert sorted(map(tuple, read_table(spark, array).select("x", "y").collect())) == [(1, "p"), (2, None)]
    single = put(tmp_path / "o.json", '{\n  "x": 3\n}\n')
    assert [r.x for r in read_table(spark, single).collect()] == [3]
    lines = put(tmp_path / "l.json", '{"x": 1}\n{"x": 2}\n')
    assert sorted(r.x for r in read_table(spark, lines).collect()) == [1, 2]
    broken = put(tmp_path / "b.json", '{"x": 1}\n{"x": \n')
    with pytest.raises(Exception):
        read_table(spark, broken).collect()


def test_snapshots_lose_nothing(spark, tmp_path):
    with pytest.raises(Exception):
        snapshot(spark, put(tmp_path / "s.csv", "a,b\n1,2,3\n"), str(tmp_path / "out1.csv"))
    with pytest.raises(ValueError, match="repeats"):
        snapshot(spark, put(tmp_path / "d.csv", "a,a\n1,2\n"), str(tmp_path / "out2.csv"))


def test_profiles_take_all_columns_unless_told(spark):
    wide = spark.range(5).select(*[F.col("id").cast("double").alias(f"n{i}") for i in range(30)])
    assert len(choose_columns(wide, ProfileSpec())[0]) == 30
    numeric, _, warnings = choose_columns(wide, ProfileSpec(max_numeric_columns=4))
    assert len(numeric) == 4 and warnings
    names = spark.range(200).select(F.col("id").cast("string").alias("name"))
    assert choose_columns(names, ProfileSpec())[1] == []
    assert choose_columns(names, ProfileSpec(keep_identifiers=True))[1] == ["name"]


@pytest.mark.parametrize(
    "field, value",
    [
        ("drop_columns", "a"), ("drop_columns", [1]), ("drop_columns", [" "]), ("log_columns", ["a", "a"]),
        ("reference_year", True), ("reference_year", "x"), ("keep_date_columns", 1),
        ("ratio_features", ["r=a/b", "r=c/d"]), ("ratio_features", ["r=a"]), ("ratio_features", ["=a/b"]),
    ],
)
def test_recipe_rules(field, value):
    with pytest.raises(ArtifactError, match=field):
        require_rules({field: value}, RECIPE_RULES, "recipe")


def test_rules_report_all_fields_at_once():
    with pytest.raises(ArtifactError, match="x must be a name; y must not be empty"):
        require_rules({"x": "", "y": []}, {"x": Rule("name"), "y": Rule("names", filled=True)}, "record")
    require_rules({}, {"x": Rule("name")}, "record")
    assert checked_ratios(["r=a/b"]) == ("r=a/b",)


def test_probability_names_take_the_next_free_number():
    used = ["probability_a", "probability_a_2"]
    assert probability_names(["a", "A!", "b"], used)[0] == "probability_a_3"
    assert len(set(probability_names(["x y", "x-y", "x_y"], []))) == 3


def test_unknown_labels_are_all_counted_and_named_in_order(spark):
    rows = spark.range(500).select(F.format_string("u%03d", "id").alias("y"), F.lit("a").alias("p"))
    rows = rows.union(spark.createDataFrame([("a", "a"), ("b", "a")], "y string, p string"))
    with pytest.raises(ValueError) as caught:
        evaluate_predictions(rows.repartition(7), "y", "p", ["a", "b"])
    first = [f"u{i:03d}" for i in range(100)]
    assert str(caught.value) == f"labels the model was not fitted on: {first} and 400 more"
    known = evaluate_predictions(rows.filter("y in ('a', 'b')"), "y", "p", ["a", "b"])
    assert known["confusion_matrix"] == [[1, 0], [1, 0]]


def test_the_forest_query_fits_the_full_forest(monkeypatch):
    seen = []
    monkeypatch.setattr(training, "_features", lambda spark, sf_dir: None)
    monkeypatch.setattr(training, "metric_rows", lambda spark, blocks: blocks)

    class Done:
        evaluation_dataset, metrics = "validation", {}

    monkeypatch.setattr(training, "train_table", lambda rows, out, spec: seen.append(spec) or Done)
    training.train_rf_metrics(None, "")
    assert seen == [TrainSpec("o_orderstatus", model_type="random_forest")]

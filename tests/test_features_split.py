import math

import numpy as np
import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tabwright.operators import split as split_module
from tabwright.operators.features import FeaturePlan, FeatureRecipe, feature_table, parse_ratio
from tabwright.operators.split import SplitSpec, split_sizes, split_table, with_quotas

# --- fixed values -----------------------------------------------------------
# (year, funding, valuation, revenue, headcount) and age, three logs, two ratios
GOLDEN = [
    ((2024, 0.4, 2.0, 0.1, 5),
     (2, 0.33647223662121295, 1.0986122886681098, 0.09531017980432487, 0.08, 20.0)),
    ((2019, 16.0, 65.0, 7.0, 82),
     (7, 2.833213344056216, 4.189654742026425, 2.0794415416798357, 0.1951219512195122, 9.285714285714286)),
    ((2023, 0.7, 3.2, 0.2, 8),
     (3, 0.5306282510621704, 1.4350845252893227, 0.18232155679395465, 0.0875, 16.0)),
]
# ----------------------------------------------------------------------------
RECIPE = FeatureRecipe(
    age_from_year_columns=("year",),
    reference_year=2026,
    log_columns=("funding", "valuation", "revenue"),
    ratio_features=("per_head=funding/headcount", "multiple=valuation/revenue"),
)


def test_golden_features(spark):
    df = spark.createDataFrame(
        [g[0] for g in GOLDEN], "year bigint, funding double, valuation double, revenue double, headcount bigint"
    )
    plan = FeaturePlan(df, RECIPE)
    rows = plan.frame().sort("funding").collect()
    for row, (_, want) in zip(rows, sorted(GOLDEN, key=lambda g: g[0][1])):
        for name, value in zip(plan.engineered, want):
            assert math.isclose(row[name], value, rel_tol=0, abs_tol=1e-9), name
    assert plan.engineered == RECIPE.generated_names()


def test_dates_keep_or_drop(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-06-30 10:00:00",), ("soon",), (None,)], "d string")
    plan = FeaturePlan(df, FeatureRecipe(date_columns=("d",)))
    assert as_set(plan.frame()) == sorted([(2024, 1, 1, 0), (2024, 6, 2, 6), (None,) * 4, (None,) * 4], key=str)
    kept = FeaturePlan(df, FeatureRecipe(date_columns=("d",), keep_date_columns=True)).frame()
    assert kept.columns[0] == "d" and kept.schema["d"].dataType.simpleString() == "timestamp"
    assert plan.warning_counts().filter("rule = 'invalid_date'").first()["rows"] == 1


def test_edges_of_ages_logs_and_ratios(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(2030, 0.0, 1.0, 0.0), (2026, -0.5, 1.0, -0.0), (None, nan, nan, 2.0), (2000, inf, inf, inf)]
    df = spark.createDataFrame(rows, "y bigint, x double, a double, b double").coalesce(1)
    recipe = FeatureRecipe(
        age_from_year_columns=("y",), reference_year=2026, log_columns=("x",),
        ratio_features=("r=a/b", "rr=r/y_age", "inv=x_log1p/a"),
    )
    plan = FeaturePlan(df, recipe)
    got = [tuple(r) for r in plan.frame().select("y_age", "x_log1p", "r", "rr", "inv").collect()]
    assert got == [
        (None, 0.0, None, None, 0.0), (0, None, None, None, None),
        (None, None, None, None, None), (26, inf, None, None, None),
    ]
    counts = {(r["rule"], r["column"]): r["rows"] for r in plan.warning_counts().collect()}
    assert counts[("future_year", "y")] == 1 and counts[("negative_log", "x")] == 1
    assert counts[("zero_denominator", "r")] == 2 and counts[("not_a_number", "x")] == 0


def test_text_numbers_in_recipes(spark):
    df = spark.createDataFrame([("2020", "1.5"), ("old", "many"), (None, None)], "y string, x string")
    recipe = FeatureRecipe(age_from_year_columns=("y",), reference_year=2026, log_columns=("x",))
    plan = FeaturePlan(df, recipe)
    assert sorted(r["y_age"] or -1 for r in plan.frame().collect()) == [-1, -1, 6.0]
    counts = {r["rule"]: r["rows"] for r in plan.warning_counts().collect()}
    assert counts == {"future_year": 0, "not_a_number": 1, "negative_log": 0}


def test_counts_include_rows_without_a_target(spark):
    df = spark.createDataFrame([(-1.0, "a"), (-2.0, None), (3.0, "b")], "x double, y string")
    plan = FeaturePlan(df, FeatureRecipe(target_column="y", log_columns=("x",)))
    counts = df.agg(*plan.counters()).first().asDict()
    assert len(plan.messages(counts)) == 2 and plan.frame().count() == 2
    assert {r["rule"]: r["rows"] for r in plan.warning_counts().collect()}["negative_log"] == 2


def test_recipe_errors(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    for recipe in (
        FeatureRecipe(drop_columns=("z",)),
        FeatureRecipe(target_column="y", drop_columns=("y",)),
        FeatureRecipe(drop_columns=("x",), log_columns=("x",)),
        FeatureRecipe(ratio_features=("y=x/x",)),
        FeatureRecipe(ratio_features=("r=x/z",)),
    ):
        with pytest.raises(ValueError):
            feature_table(df, recipe)
    assert feature_table(df, FeatureRecipe(drop_columns=("z",), ignore_missing_drops=True)).columns == ["x", "y"]
    with pytest.raises(ValueError):
        FeatureRecipe(age_from_year_columns=("x",))
    for text in ("r", "r=a", "=a/b", "r=/b", "r=a/ "):
        with pytest.raises(ValueError):
            parse_ratio(text)
    assert parse_ratio(" r = a / b/c ") == ("r", "a", "b/c")


def test_recipe_is_one_projection(spark):
    df = spark.range(10).select(F.col("id").alias("year"), *[F.lit(1.0).alias(c) for c in ("funding", "valuation", "revenue")], F.lit(2).alias("headcount"))
    plan = FeaturePlan(df.repartition(2), RECIPE).frame()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 2


# --- quotas -----------------------------------------------------------------
def expected_quota(n, fractions):
    exact = np.array(fractions) * n
    counts = np.floor(exact).astype(int)
    order = np.argsort(-(exact - counts), kind="stable")
    for i in order[: n - counts.sum()]:
        counts[i] += 1
    return tuple(int(c) for c in counts)


@pytest.mark.parametrize("fractions", [(0.7, 0.15, 0.15), (0.5, 0.25, 0.25), (0.8, 0.0, 0.2), (1.0, 0.0, 0.0), (1 / 3, 1 / 3, 1 / 3)])
def test_quotas(spark, fractions):
    got = with_quotas(spark.range(1, 200).select(F.col("id").alias("n")), fractions).sort("n").collect()
    for r in got:
        assert (r["train"], r["validation"], r["test"]) == expected_quota(r["n"], fractions), r


# --- splits -----------------------------------------------------------------
def sizes(frame, *by):
    return {tuple(r[:-1]): r[-1] for r in frame.groupBy(*by, "split").count().collect()}


def test_two_classes_of_twelve(companies):
    result = split_table(companies, SplitSpec(target_column="status", seed=17, key_columns=("company_id",)))
    for label in ("Acquired", "Independent"):
        found = sizes(result.frame.filter(F.col("status") == label))
        assert found == {("train",): 8, ("validation",): 2, ("test",): 2}
    assert {r["split"]: r["rows"] for r in split_sizes(result).collect()} == {"train": 16, "validation": 4, "test": 4}
    assert result.warning is None
    assert as_set(result.frame.drop("split")) == as_set(companies)


def test_split_does_not_depend_on_partitions_or_order(companies):
    spec = SplitSpec(target_column="status", seed=3, key_columns=("company_id",))
    a = split_table(companies.repartition(16), spec).frame.select("company_id", "split")
    b = split_table(companies.orderBy(F.desc("company_id")).coalesce(1), spec).frame.select("company_id", "split")
    assert as_set(a) == as_set(b)
    other = split_table(companies, SplitSpec(target_column="status", seed=4, key_columns=("company_id",)))
    assert as_set(other.frame.select("company_id", "split")) != as_set(a)


def test_split_equals_plain_ranking(spark):
    import hashlib

    df = spark.range(500).withColumn("c", F.when(F.col("id") % 3 == 0, "x").otherwise("y"))
    spec = SplitSpec(target_column="c", seed=5, key_columns=("id",))
    got = {r["id"]: r["split"] for r in split_table(df, spec).frame.collect()}
    for label in "xy":
        ids = [i for i in range(500) if (i % 3 == 0) == (label == "x")]
        ids.sort(key=lambda i: hashlib.md5(f"5|{len(str(i))}:{i}".encode()).hexdigest())
        a, b, _ = expected_quota(len(ids), spec.fractions)
        want = ["train"] * a + ["validation"] * b + ["test"] * (len(ids) - a - b)
        assert [got[i] for i in ids] == want


@pytest.mark.parametrize(
    "keys, group_rows, copies",
    [((), 4_000_000, 1_000_000), ((), 7, 11), (("k",), 4_000_000, 1_000_000), (("k",), 7, 11), (("k", "v"), 7, 11)],
)
def test_hot_keys_and_copies_get_exact_quotas(spark, monkeypatch, keys, group_rows, copies):
    """Half of the rows are copies of one row; keys repeat."""
    monkeypatch.setattr(split_module, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(split_module, "COPIES_PER_TASK", copies)
    df = spark.range(400).select(
        (F.col("id") % 2).alias("k"),
        F.when(F.col("id") % 2 == 0, "same").otherwise((F.col("id") % 90).cast("string")).alias("v"),
    )
    spec = SplitSpec(key_columns=keys, seed=9)
    first = split_table(df, spec).frame
    assert sizes(first) == {("train",): 280, ("validation",): 60, ("test",): 60}
    assert as_set(first.drop("split")) == as_set(df)
    assert as_set(split_table(df.repartition(13), spec).frame) == as_set(first)


def test_any_column_name_but_split(spark):
    df = spark.range(60).select(F.col("id").alias("h"), (F.col("id") % 2).alias("place"), F.lit(1).alias("copies"))
    result = split_table(df, SplitSpec(target_column="place", key_columns=("h",)))
    assert result.frame.columns == ["h", "place", "copies", "split"]
    plain = split_table(df.toDF("a", "b", "c"), SplitSpec(target_column="b", key_columns=("a",)))
    assert as_set(result.frame) == as_set(plain.frame)
    assert "h looks" in split_table(df, SplitSpec(target_column="h", key_columns=("h",))).warning
    with pytest.raises(ValueError, match="named split"):
        split_table(df.withColumn("split", F.lit(1)), SplitSpec())


def test_fallbacks(spark):
    df = spark.range(100).withColumn("one", F.lit("a")).withColumn("rare", F.when(F.col("id") < 2, "r").otherwise("s"))
    spec = dict(key_columns=("id",))
    for target, part in (("one", "fewer than two"), ("id", "continuous"), ("rare", "fewer rows")):
        result = split_table(df, SplitSpec(target_column=target, **spec))
        assert part in result.warning
        assert sizes(result.frame) == {("train",): 70, ("validation",): 15, ("test",): 15}
    off = split_table(df, SplitSpec(target_column="rare", stratify=False, **spec))
    assert off.warning is None


def test_missing_class_is_a_class(spark):
    df = spark.range(40).withColumn("c", F.when(F.col("id") < 20, "a"))
    result = split_table(df, SplitSpec(0.5, 0.25, 0.25, target_column="c", key_columns=("id",)))
    assert sizes(result.frame, "c") == {
        (c, s): n for c in ("a", None) for s, n in (("train", 10), ("validation", 5), ("test", 5))
    }


def test_unused_and_empty_splits(spark):
    df = spark.range(10)
    assert sizes(split_table(df, SplitSpec(0.8, 0.0, 0.2)).frame) == {("train",): 8, ("test",): 2}
    with pytest.raises(ValueError, match="empty"):
        split_table(spark.range(1), SplitSpec())
    with pytest.raises(ValueError, match="no rows"):
        split_table(df.limit(0), SplitSpec())
    for bad in ((0.5, 0.5, 0.5), (-0.1, 0.6, 0.5), (0.0, 0.5, 0.5)):
        with pytest.raises(ValueError):
            SplitSpec(*bad)


def test_final_assignment_has_no_shuffle(spark, tmp_path):
    spark.range(1000).withColumn("c", F.col("id") % 2).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    frame = split_table(df, SplitSpec(target_column="c", key_columns=("id",))).frame
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan

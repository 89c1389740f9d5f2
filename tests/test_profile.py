import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators.profile import (
    ProfileSpec,
    choose_columns,
    correlations,
    describe_numbers,
    head_rows,
    histogram,
    overview_record,
    profile_tables,
)
from tabwright.operators.quantiles import exact_medians, exact_percentiles, percentiles_table


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize(
    "kind, small_rows",
    [("uniform", 1_000_000), ("heavy", 1_000_000), ("uniform", 20), ("heavy", 1), ("two values", 3), ("wide", 1), ("signs", 3)],
)
def test_percentiles_are_exact(spark, kind, small_rows):
    rng = np.random.default_rng(1)
    values = {
        "uniform": rng.random(501),
        "heavy": np.concatenate([np.full(200, 5.0), rng.normal(5, 1, 400)]),
        "two values": np.array([1.0] * 250 + [2.0] * 250),
        "wide": 10.0 ** rng.uniform(-300, 300, 400),
        "signs": np.concatenate([np.full(50, -0.0), np.full(50, 0.0), rng.normal(0, 1, 200)]),
    }[kind]
    p = [0.0, 0.25, 0.5, 0.75, 0.991, 1.0]
    got = exact_percentiles(frame(spark, values), ["x"], p, small_rows=small_rows)["x"]
    for a, b in zip(got, np.percentile(values, np.array(p) * 100)):
        assert math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)


def test_percentile_edges(spark):
    nan = float("nan")
    assert exact_medians(frame(spark, [1, 2, 10, nan, None]), ["x"]) == {"x": 2.0}
    assert exact_medians(frame(spark, [3]), ["x"], small_rows=0) == {"x": 3.0}
    assert exact_medians(frame(spark, [None, None]), ["x"]) == {"x": None}
    assert percentiles_table(frame(spark, [1, 2]), ["x"], [0.5]).first()["value"] == 1.5


@pytest.mark.parametrize("values", [np.linspace(0, 1, 101), np.array([0.1] * 5 + [0.7, 0.3, 0.9]), np.arange(31) / 10, np.full(4, 2.5)])
def test_histogram_matches_numpy(spark, values):
    counts, edges = np.histogram(values, bins=30)
    got = histogram(frame(spark, [*values, None]), ["x"], 30).sort("bin").collect()
    assert [r["n"] for r in got] == counts.tolist()
    assert np.allclose([r["low"] for r in got], edges[:-1]) and math.isclose(got[-1]["high"], edges[-1])


def test_histogram_without_values(spark):
    assert histogram(frame(spark, [None]), ["x"]).count() == 0


def test_correlation(spark):
    rows = [(1.0, 2.0, 5.0, None), (2.0, 4.1, 5.0, 1.0), (3.0, 5.9, 5.0, 2.0), (None, 1.0, 5.0, 9.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r["left"], r["right"]): r["correlation"] for r in correlations(df, ["a", "b", "c", "d"]).collect()}
    assert len(got) == 16 and got[("a", "a")] == 1.0
    assert math.isclose(got[("a", "b")], np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1], rel_tol=1e-12)
    assert got[("b", "a")] == got[("a", "b")] and got[("a", "c")] is None and got[("c", "c")] is None
    assert got[("a", "d")] == 1.0


def test_correlation_with_infinite_values_is_missing(spark):
    rows = [(1.0, 2.0, float("inf")), (2.0, 1.0, 1.0), (4.0, 9.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["left"], r["right"]): r["correlation"] for r in correlations(df, ["a", "b", "c"]).collect()}
    assert got[("a", "c")] is None and got[("c", "c")] is None
    assert math.isclose(got[("a", "b")], np.corrcoef([1, 2, 4], [2, 1, 9])[0, 1], rel_tol=1e-12)


def test_describe(spark):
    r = describe_numbers(frame(spark, [1, 2, 3, 4, None]), ["x"]).first()
    assert (r["n"], r["mean"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (4, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0)
    assert math.isclose(r["std"], np.std([1, 2, 3, 4], ddof=1))


def test_column_choice(spark):
    df = spark.range(200).select(
        F.col("id").alias("n"), F.col("id").cast("string").alias("code"), F.lit("a").alias("user_id"),
        (F.col("id") % 3).cast("string").alias("kind"), (F.col("id") > 5).alias("flag"), F.lit("t").alias("y"),
    )
    numeric, categorical, warnings = choose_columns(df, ProfileSpec(target_column="y"))
    assert (numeric, categorical, len(warnings)) == (["n"], ["kind", "flag"], 2)
    _, one, more = choose_columns(df, ProfileSpec(max_categorical_columns=1))
    assert one == ["kind"] and len(more) == 3
    assert choose_columns(df, ProfileSpec(categorical_columns=("code",)))[1] == ["code"]
    with pytest.raises(ValueError):
        ProfileSpec(histogram_bins=0)


def test_profile_outputs(spark, companies):
    tables, warnings = profile_tables(companies, ProfileSpec(target_column="status"))
    assert set(tables) == {"overview", "target", "missing", "histogram", "medians", "correlation", "categories"}
    assert tables["missing"].collect()[0]["column"] == "ai_adoption_level"
    assert any("company_id" in w for w in warnings)
    text_only, warnings = profile_tables(companies.select("domain"), ProfileSpec())
    assert "histogram" not in text_only and "missing" not in text_only and warnings
    record = overview_record(companies, ProfileSpec(target_column="status"), "companies")
    assert record["row_count"] == 24 and record["missing_values"]["ai_adoption_level"] == 2


def test_head_needs_an_order(companies):
    assert [r["company_id"] for r in head_rows(companies, ["company_id"], 2).collect()] == ["S001", "S002"]

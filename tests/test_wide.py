import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tabwright.operators import train
from tabwright.operators.features import FeatureRecipe
from tabwright.operators.gram import blocked_correlations
from tabwright.operators.preprocess import fit_preprocessing, training_statistics
from tabwright.operators.score import score_table
from tabwright.operators.split import SplitSpec
from tabwright.operators.train import TrainSpec, fit_model
from tabwright.plans import training
from tabwright.sources.artifacts import load_artifact, save_artifact


@pytest.fixture(scope="module")
def codes(spark):
    """A column of 200,000 categories, a hot one with a third of the rows, gaps."""
    code = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None)
    code = code.otherwise(F.concat(F.lit("c"), F.col("id").cast("string")))
    return spark.range(300_150).select(
        code.alias("code"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).cast("double").alias("x"),
        (F.col("id") % 4).cast("string").alias("kind"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("label"),
    )


def test_200000_categories_are_encoded(spark, codes):
    plan = fit_preprocessing(codes, ["x"], ["kind", "code"])
    size = plan.dictionary.sizes["code"]
    assert size > 199_000 and "code" not in plan.categories and plan.modes["code"] == "hot"
    assert plan.width() == 1 + 4 + size
    from pyspark.ml import PipelineModel

    stages = PipelineModel(plan.transformers(codes))
    rows = codes.limit(0).union(
        spark.createDataFrame([("c2", 1.0, "0", "a"), (None, None, "3", "a"), ("new", 2.0, "9", "b"), ("hot", 1.0, "1", "a")], codes.schema)
    )
    got = stages.transform(plan.dictionary.add_slots(rows)).select("code", "tw_features").collect()
    words = spark.read.parquet(plan.dictionary.path)
    assert words.count() == size and words.agg(F.max("slot")).first()[0] == size - 1
    slot = {r.value: r.slot for r in words.filter("value in ('c2', 'hot')").collect()}
    assert slot["hot"] == size - 1  # the last in order
    # categories come in the order of the features: one number, four kinds, then the codes
    for r in got:
        hot = [int(i) for i in r.tw_features.indices if i > 4]
        want = {"c2": [5 + slot["c2"]], None: [5 + slot["hot"]], "new": [], "hot": [5 + slot["hot"]]}[r.code]
        assert hot == want and r.tw_features.size == plan.width()


def test_a_model_with_a_dictionary_equals_one_without(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [("abcdef"[i % 6] if i % 11 else None, float(rng.standard_normal()), "yn"[int(rng.random() < 0.2 + (i % 6) / 10)]) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, x double, label string")
    listed, _, _ = fit_model(df, TrainSpec("label"))
    wide, _, _ = fit_model(df, TrainSpec("label", listed=3))
    assert wide.dictionary.sizes == {"g": 6} and listed.dictionary is None
    save_artifact(spark, wide, str(tmp_path / "m"))
    new = df.union(spark.createDataFrame([("zz", 0.5, "y")], df.schema))
    for model in (wide, load_artifact(spark, str(tmp_path / "m"))):
        a = score_table(new, listed).frame.orderBy("x", "g").collect()
        b = score_table(new, model).frame.orderBy("x", "g").collect()
        assert all(abs(r.probability_y - s.probability_y) < 1e-6 for r, s in zip(a, b)) and len(a) == len(b)


def test_statistics_take_few_passes(spark, companies):
    """Scales from merged moments equal those of the filled column."""
    rows = companies.withColumn("gap", F.when(F.col("total_funding") > 30, F.col("revenue")))
    known = training_statistics(rows, ["gap", "headcount"], ["domain", "ai_adoption_level"], "status")
    assert known.rows == 24 and known.sizes["ai_adoption_level"][1] == 22 and known.empty() == []
    plan = fit_preprocessing(rows, ["gap", "headcount"], [], statistics=known)
    filled = rows.select(F.coalesce("gap", F.lit(plan.medians["gap"])).alias("v"))
    mean, deviation = filled.agg(F.avg("v"), F.stddev_pop("v")).first()
    assert np.isclose(plan.means["gap"], mean) and np.isclose(plan.scales["gap"], deviation)
    constant = rows.withColumn("one", F.when(F.col("headcount") > 30, F.lit(7.0)))
    assert fit_preprocessing(constant, ["one"], []).scales["one"] == 1.0


# --- correlations in one pass -------------------------------------------------
def test_blocked_correlations_read_the_rows_once(spark):
    """Partitions far apart, columns that vary only between them, gaps that come late, and an
    infinite value in a row that its partner lacks."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 6)) @ rng.standard_normal((6, 6))
    x += 1e6 * (np.arange(400) // 100)[:, None]
    x[:, 2] = np.arange(400) // 100
    x[:, 3] = 7.25
    x[250:, 4] = np.nan
    x[::7, 1] = np.nan
    x[3, 5], x[3, 4] = np.inf, np.nan
    names = [f"c{i}" for i in range(6)]
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    df = spark.createDataFrame([[i // 100, *r] for i, r in enumerate(rows)], "p int, " + ", ".join(f"{c} double" for c in names))
    df = df.repartitionByRange(4, "p").select(names).localCheckpoint()
    spark.sparkContext.setJobGroup("correlations", "")
    found = blocked_correlations(df, names)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("correlations")
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 2
    got = {(r.left, r.right): r.correlation for r in found.collect()}
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if 3 in (i, j) or 5 in (i, j):
                assert got[a, b] is None
            else:
                assert abs(got[a, b] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9


# --- equal rows before the solver ---------------------------------------------
def test_equal_rows_reach_the_solver_as_one(spark, monkeypatch):
    """Without numbers the solver gets one row for each pattern, gaps and a hot one included, and
    finds the model that it finds from all rows."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 1, F.concat(F.lit("k"), F.col("id") % 4)).alias("kind"),
        F.when(F.col("id") % 5 != 2, F.date_add(F.lit("2020-01-01"), (F.col("id") % 3).cast("int"))).alias("day"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * F.col("id")) % 3).alias("label"),
    )
    read, fit = [], LogisticRegression.fit

    def counting(self, matrix, *rest):
        read.append(matrix.agg(F.count("*"), F.round(F.sum("tw_weight"), 6)).first())
        return fit(self, matrix, *rest)

    monkeypatch.setattr(LogisticRegression, "fit", counting)
    spec = TrainSpec("label", inverse_regularization=10.0, tolerance=1e-12)
    artifact, total, _ = fit_model(rows, spec)
    monkeypatch.setattr(train, "TASK_ROWS", 0)
    whole, _, _ = fit_model(rows, spec)
    (counted, weight), (everything, same) = read
    assert counted <= 6 * 4 * 3 < everything == total and weight == same == total
    kinds = rows.drop("label").distinct().withColumn("key", F.concat_ws("|", "kind", "day", F.isnull("kind"), F.isnull("day")))
    a, b = ({r.key: list(r)[1:] for r in score_table(kinds, m, keep=["key"]).frame.collect()} for m in (artifact, whole))
    assert len(a) > 12 and a.keys() == b.keys()
    for key in a:
        assert a[key][0] == b[key][0] and np.allclose(a[key][1:], b[key][1:], atol=1e-6)


def test_patterns_beyond_the_limit_or_numbers_are_left_alone(spark):
    rows = spark.range(100).select(
        F.col("id").cast("string").alias("code"), (F.col("id") % 5).alias("x"), (F.col("id") % 2).alias("label")
    )
    for columns in (["code", "label"], ["x", "label"]):
        artifact, total, _ = fit_model(rows.select(columns), TrainSpec("label"))
        assert total == 100 and score_table(rows, artifact).frame.count() == 100


# --- counts of the source in the write ----------------------------------------
@pytest.mark.parametrize("ways", ["split", "copies", "unsplit"])
def test_source_rows_and_warnings_are_counted_by_the_write(spark, tmp_path, monkeypatch, ways):
    """One pass over the rows counts them; copies that lie on a cut are read twice there, so they
    are counted apart."""
    number = F.lit(3) if ways == "copies" else F.col("id")
    rows = spark.range(400).select(
        (number - 5).alias("n"), F.lit(0).alias("none"),
        F.when(F.col("id") % 8 != 0, F.when(F.col("id") % 2 == 0, "a").otherwise("b")).alias("label"),
    )
    rows.repartition(4).write.parquet(f"{tmp_path}/source.parquet")
    plans, write = [], training.write_table

    def looking(frame, *rest, **options):
        plans.append(frame._jdf.queryExecution().analyzed().toString())
        write(frame, *rest, **options)

    monkeypatch.setattr(training, "write_table", looking)
    recipe = FeatureRecipe(target_column="label", log_columns=("n",), ratio_features=("r=n/none",))
    split = None if ways == "unsplit" else SplitSpec(seed=1)
    built = training.build_features(spark, f"{tmp_path}/source.parquet", f"{tmp_path}/out.parquet", recipe, split)
    assert plans[0].count("CollectMetrics seen") == (ways != "copies")
    assert (built.input_rows, built.output_rows, built.dropped_target_rows) == (400, 350, 50)
    assert sum(built.split_rows.values()) == (0 if ways == "unsplit" else 350)
    negative = {"copies": 400}.get(ways, 5)
    assert [int(w.split(" values of n are")[0]) for w in built.warnings if "negative" in w] == [negative]
    assert sum("400 zero denominators" in w for w in built.warnings) == 1
    assert sum("50 rows without a value in label" in w for w in built.warnings) == 1


def test_empty_sources_are_refused_before_anything_is_written(spark, tmp_path):
    rows = spark.range(20).select("id", F.lit(None).cast("string").alias("label"))
    rows.write.parquet(f"{tmp_path}/blank.parquet")
    rows.limit(0).write.parquet(f"{tmp_path}/empty.parquet")
    for name, text in (("blank", "no row has a target value"), ("empty", "the source table has no rows")):
        with pytest.raises(ValueError, match=text):
            training.build_features(
                spark, f"{tmp_path}/{name}.parquet", f"{tmp_path}/{name}_out.parquet",
                FeatureRecipe(target_column="label"), SplitSpec(),
            )
        assert not (tmp_path / f"{name}_out.parquet").exists()

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import forest
from tabwright.operators.forest import ForestSpec
from tabwright.operators.score import score_table
from tabwright.operators.train import TrainSpec, fit_model
from tabwright.sources.artifacts import load_artifact, save_artifact


def brute_tree(x, y, w, classes):
    """Training error-free tree shape by plain recursion over all features: the root's split."""
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for a, b in zip(values, values[1:]):
            side = x[:, f] <= (a + b) / 2
            impurity = 0.0
            for part in (side, ~side):
                mass = np.bincount(y[part], w[part], classes)
                impurity += mass.sum() - (mass**2).sum() / mass.sum()
            if best is None or impurity < best[0] - 1e-9:
                best = (impurity, f, (a + b) / 2)
    return best


@pytest.mark.parametrize("seed", range(8))
def test_the_root_has_the_best_of_all_thresholds(seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.standard_normal((60, 1)), 1)
    y, w = rng.integers(0, 3, 60), rng.integers(1, 4, 60).astype(float)
    nodes, shares = forest.grow_tree(x, y, w, 3, seed)
    impurity, feature, threshold = brute_tree(x, y, w, 3)
    root = nodes[0]
    side = x[:, root["feature"]] <= root["threshold"]
    own = sum(
        m.sum() - (m**2).sum() / m.sum() for m in (np.bincount(y[s], w[s], 3) for s in (side, ~side))
    )
    assert math.isclose(own, impurity, abs_tol=1e-9) and root["feature"] == feature
    # equal rows with different labels end in one leaf with their shares
    got = forest.tree_shares(x, nodes, shares)
    for v in np.unique(x):
        mass = np.bincount(y[x[:, 0] == v], w[x[:, 0] == v], 3)
        assert np.allclose(got[x[:, 0] == v], mass / mass.sum())


@pytest.mark.parametrize("width", [1, 3, 9])
def test_a_tree_separates_all_distinct_rows(width):
    rng = np.random.default_rng(width)
    x = rng.standard_normal((400, width))
    x[:, 0] = rng.permutation(400)
    x[:, -1] = np.round(x[:, -1]) if width > 1 else x[:, -1]
    y = rng.integers(0, 5, 400)
    nodes, shares = forest.grow_tree(x, y, np.ones(400), 5, 1)
    assert (forest.tree_shares(x, nodes, shares).argmax(1) == y).all()
    inner = nodes["feature"] >= 0
    assert len(nodes) == 2 * inner.sum() + 1  # every inner node has two children
    same, _ = forest.grow_tree(x, y, np.ones(400), 5, 1)
    assert (same == nodes).all()


def test_one_class_and_one_row():
    nodes, shares = forest.grow_tree(np.zeros((1, 2)), np.array([1]), np.ones(1), 2, 0)
    assert len(nodes) == 1 and shares.tolist() == [[0.0, 1.0]]


def test_draws_are_poisson():
    rows = np.arange(100_000)
    for mean in (1, 4, 1300):
        drawn = forest.poisson(rows, np.full(len(rows), mean), mean)
        assert abs(drawn.mean() - mean) < 5 * math.sqrt(mean / len(rows))
        assert abs(drawn.var() / mean - 1) < 0.03
    assert (forest.poisson(rows[500:700], np.ones(200), 9) == forest.poisson(rows, np.ones(len(rows)), 9)[500:700]).all()


@pytest.fixture(scope="module")
def noisy(spark):
    """Labels that no threshold on few levels tells apart, a hot row, a gap, a category."""
    rng = np.random.default_rng(11)
    rows = [
        (float(i), float(rng.standard_normal()), None if i % 40 == 1 else "abc"[i % 3], "xyz"[int(rng.integers(3))])
        for i in range(300)
    ]
    rows += [(1000.0, 0.0, "a", "x")] * 150 + [(1001.0, 0.0, "a", "x"), (1001.0, 0.0, "a", "y"), (1001.0, 0.0, "a", "y")]
    return spark.createDataFrame(rows, "u double, v double, g string, label string").repartition(4)


@pytest.mark.parametrize("subtree_bytes", [64 << 20, 4000])
def test_forest_without_bootstrap_repeats_its_labels(spark, noisy, tmp_path, subtree_bytes):
    spec = TrainSpec(
        "label", model_type="exact_forest", n_estimators=6, bootstrap=False, class_weight=None,
        subtree_bytes=subtree_bytes,
    )
    artifact, total, _ = fit_model(noisy, spec)
    assert total == 453 and artifact.forest.upper == (subtree_bytes == 4000)
    save_artifact(spark, artifact, str(tmp_path / "m"))
    loaded = load_artifact(spark, str(tmp_path / "m"))
    for model in (artifact, loaded):
        scored = score_table(noisy, model)
        wrong = scored.frame.filter(F.col("predicted_label") != F.col("label")).collect()
        # only the row whose features have two labels: the more frequent one wins
        assert [(r.u, r.label, r.predicted_label) for r in wrong] == [(1001.0, "x", "y")]
        p = [F.col(c) for c in scored.probability_columns]
        assert scored.frame.filter(F.abs(p[0] + p[1] + p[2] - 1) > 1e-9).count() == 0


def test_bootstrap_and_blocks(spark, noisy):
    spec = TrainSpec("label", model_type="exact_forest", n_estimators=40, seed=3)
    artifact, _, _ = fit_model(noisy, spec)
    scored = score_table(noisy, artifact).frame
    right = scored.filter(F.col("predicted_label") == F.col("label")).count()
    assert right >= 440  # out of 453: a row is in two of three trees
    small = forest.Forest(artifact.forest.path, 40, 3, False, 30_000)
    assert len(small.blocks(spark)) > 3
    parts = artifact.pipeline.transform(noisy)
    one = artifact.forest.add_probabilities(parts).select("u", "v", "label", "probability")
    many = small.add_probabilities(parts).select("u", "v", "label", "probability")
    a = {tuple(r)[:3]: r.probability for r in one.collect()}
    b = {tuple(r)[:3]: r.probability for r in many.collect()}
    assert all(np.allclose(a[k], b[k]) for k in a)
    again, _, _ = fit_model(noisy.repartition(7), spec)  # draws follow from the rows alone
    c = {tuple(r)[:3]: r.probability for r in again.transform(noisy).select("u", "v", "label", "probability").collect()}
    assert all(np.allclose(a[k], c[k]) for k in a)


def test_a_forest_needs_rows(spark):
    empty = spark.createDataFrame([], "a double, label string")
    with pytest.raises(ValueError):
        fit_model(empty, TrainSpec("label", model_type="exact_forest"))
    assert ForestSpec().trees == 300


def matrix_of(spark, x, y, n=1):
    from pyspark.ml.functions import array_to_vector

    rows = [(v, float(c)) for v, c in zip(x.tolist(), y.tolist()) for _ in range(n)]
    df = spark.createDataFrame(rows, "x array<double>, tw_label double")
    return df.select(array_to_vector("x").alias("tw_features"), "tw_label", F.lit(1.0).alias("tw_weight")).repartition(3)


@pytest.mark.parametrize("width, classes, bootstrap", [(2, 5, False), (2, 3, True), (7, 2, True), (300, 9, False)])
def test_tasks_grow_the_trees_of_the_numpy_functions(spark, width, classes, bootstrap):
    rng = np.random.default_rng(width)
    x = np.round(rng.standard_normal((200, width)), 1)
    x[:, 0] = np.abs(x[:, 0])
    x[rng.random(200) < 0.2] = x[0]  # equal rows with different labels
    y = rng.integers(0, classes, 200)
    y[:classes] = np.arange(classes)
    weights = [1.0 + 0.37 * c for c in range(classes)]
    spec = ForestSpec(trees=12, seed=5, bootstrap=bootstrap)
    grown, stages = forest.fit_forest(matrix_of(spark, x, y, 2), weights, spec)
    assert not stages and not grown.upper
    counted = forest.counted_rows(matrix_of(spark, x, y, 2)).orderBy("row").collect()
    own = np.array([r.x for r in counted])
    label, copies = (np.array([r[c] for r in counted]) for c in ("label", "copies"))
    row = np.array([r.row for r in counted])
    found = spark.read.parquet(grown.path).orderBy("tree").collect()
    assert [r.tree for r in found] == list(range(12))
    total = np.zeros((len(x), classes))
    for r in found:
        drawn = forest.poisson(row, copies, 5 * 100_003 + r.tree) if bootstrap else copies
        kept = drawn > 0
        nodes, shares = forest.grow_tree(
            own[kept], label[kept], drawn[kept].astype(float), classes, [5, r.tree, 0], weights
        )
        assert (forest.unpack_nodes(r.nodes) == nodes).all()
        assert (np.frombuffer(r.shares).reshape(-1, classes) == shares).all()
        assert r.size == nodes.nbytes + shares.nbytes
        total += forest.tree_shares(x, nodes, shares)
    expected = {tuple(a): b for a, b in zip(x.tolist(), (total / 12).tolist())}
    blocks = forest.Forest(grown.path, 12, classes, False, 5000)
    assert len(blocks.blocks(spark)) > 1
    for model in (grown, blocks):
        scored = model.add_probabilities(matrix_of(spark, x, y)).collect()
        assert len(scored) == 200
        for r in scored:
            assert np.allclose(r.probability, expected[tuple(r.tw_features.toArray().tolist())], rtol=0, atol=1e-12)
            assert r.prediction == int(np.argmax(r.probability))


def test_rows_go_to_the_trees_in_blocks(spark, noisy, monkeypatch):
    """More blocks of trees than of rows, fewer, and rows in several blocks and parts."""
    spec = TrainSpec("label", model_type="exact_forest", n_estimators=20, seed=3)
    artifact, _, _ = fit_model(noisy, spec)
    parts = artifact.pipeline.transform(noisy).select("u", "v", "label", "tw_features")
    expected = sorted(tuple(r)[:3] + tuple(r.probability) for r in artifact.forest.add_probabilities(parts).collect())
    small = forest.Forest(artifact.forest.path, 20, 3, False, 20_000)
    ways = []
    monkeypatch.setattr(forest.Forest, "summed", lambda self, *a, f=forest.Forest.summed: ways.append(a[1:]) or f(self, *a))
    monkeypatch.setattr(forest, "PART", 50)
    for most, jobs in ((128 << 20, 1), (8 * 8 * 300, 2), (8, 0)):
        monkeypatch.setattr(forest, "ROWS_BYTES", most)
        ways.clear()
        got = sorted(tuple(r)[:3] + tuple(r.probability) for r in small.add_probabilities(parts).collect())
        assert [a[:3] for a in got] == [a[:3] for a in expected] and len(got) == 453
        assert np.allclose([a[3:] for a in got], [a[3:] for a in expected], rtol=0, atol=1e-12)
        assert len(ways) == jobs


def test_tables_of_plain_nodes_are_still_scored(spark, noisy, tmp_path):
    spec = TrainSpec("label", model_type="exact_forest", n_estimators=5, seed=3)
    artifact, _, _ = fit_model(noisy, spec)
    found = spark.read.parquet(artifact.forest.path).collect()
    plain = [(r.tree, r.leaf, bytearray(forest.unpack_nodes(r.nodes).tobytes()), r.shares) for r in found]
    spark.createDataFrame(plain, "tree int, leaf int, nodes binary, shares binary").write.parquet(str(tmp_path / "f"))
    parts = artifact.pipeline.transform(noisy).select("u", "v", "label", "tw_features")
    old = forest.Forest(str(tmp_path / "f"), 5, 3)
    for model in (old, forest.Forest(old.path, 5, 3, False, 1)):
        got = sorted(tuple(r)[:3] + tuple(r.probability) for r in model.add_probabilities(parts).collect())
        expected = sorted(tuple(r)[:3] + tuple(r.probability) for r in artifact.forest.add_probabilities(parts).collect())
        assert np.allclose([a[3:] for a in got], [a[3:] for a in expected], rtol=0, atol=1e-12)


def test_a_forest_of_many_rows_counts_them_by_bins(spark, tmp_path, monkeypatch):
    """Spark ML's trees on counted rows: every tree draws Poisson counts, of all rows together."""
    from tabwright.operators import train
    from tabwright.session import spread

    monkeypatch.setattr(train, "TASK_ROWS", 500)
    points = []
    counted = train.fit_counted
    monkeypatch.setattr(train, "fit_counted", lambda *a: points.append(a[1].count()) or counted(*a))
    rows = [(float(i % 7), "abc"[i % 3], "xyz"[i % 7 // 3 if i % 5 else i % 3]) for i in range(4200)]
    df = spark.createDataFrame(rows, "u double, g string, label string").coalesce(1)
    spec = TrainSpec("label", model_type="random_forest", n_estimators=60, class_weight=None)
    artifact, total, _ = fit_model(df, spec)
    assert total == 4200 and points == [4200]
    model = artifact.pipeline.stages[-1]
    drawn = [t.rootNode().impurityStats().count() for t in model._java_obj.trees()]
    assert len(set(drawn)) > 30 and abs(np.mean(drawn) - 4200) < 5 * math.sqrt(4200 / 60)
    assert 0.4 < np.var(drawn) / 4200 < 2
    assert model.numClasses == 3 and model.getFeaturesCol() == "tw_features" and model.getNumTrees == 60
    save_artifact(spark, artifact, str(tmp_path / "m"))
    cells = df.select("u", "g").distinct()

    def probabilities(model):
        scored = score_table(cells, model)
        return {(r.u, r.g): [r[c] for c in scored.probability_columns] for r in scored.frame.collect()}

    found = probabilities(artifact)
    assert len(found) == 21 and probabilities(load_artifact(spark, str(tmp_path / "m"))) == found
    monkeypatch.setattr(train, "TASK_ROWS", 10_000)  # Spark's own draws, row by row
    plain, _, _ = fit_model(df, spec)
    assert len(points) == 1
    expected = probabilities(plain)
    assert all(np.allclose(found[k], expected[k], rtol=0, atol=0.1) for k in expected)
    monkeypatch.setattr(train, "TASK_ROWS", 500)
    again = probabilities(fit_model(df.repartition(5), spec)[0])  # draws follow from the rows alone
    assert all(np.allclose(found[k], again[k], rtol=0, atol=1e-9) for k in found)
    assert spread(df, 4200, 1000).rdd.getNumPartitions() == 5 and spread(df, 4200, 4200) is df

import math

import numpy as np
import pytest

from tabwright.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, dims long, n string, body string"


def make(spark, vectors):
    rows = [(i, v, 0, "x", 1, "n", "b") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_hand(vectors):
    """(ids, x, n, sums, eigenvalues, eigenvectors) of the usable rows, with a dense solver."""
    ok = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) and abs(c) <= 2**30 for c in v)]
    dims = len(ok[0][1])
    ok = [(i, v) for i, v in ok if len(v) == dims]
    x = np.floor(64 * np.array([np.float32(v) for _, v in ok], dtype=float)).astype(int) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(0)
    c = (n * distinct - sums) / n
    values, vectors_ = np.linalg.eigh(c.T @ c / n)
    return [i for i, _ in ok], x, n, sums, values[::-1], vectors_[:, ::-1]


def check(got, vectors, distinct_values=True):
    ids, x, n, sums, values, turn = by_hand(vectors)
    kept = int((values[:16] > 1e-12 * values[0]).sum())
    assert len(got) == len(ids) * kept
    got = sorted(got, key=lambda r: (r.vec_id, r.component))
    order = np.argsort(ids, kind="stable")
    assert {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, kept + 1))
    explained = [r.explained for r in sorted(got, key=lambda r: r.component)][:: len(ids)]
    assert np.allclose(explained, values[:kept] / values.sum(), rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    if len(set(ids)) == len(ids):
        white = np.array([r.whitened for r in got]).reshape(len(ids), kept)
        away = [r.deviation for r in got][::kept]
        assert away == [sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[i], sums)) for i in order]
        if distinct_values:
            mine = ((n * x - sums) / n @ turn[:, :kept] / np.sqrt(values[:kept]))[order]
            white = white * np.sign((white * mine).sum(0))
            assert np.abs(white - mine).max() < 1e-8


def test_against_a_dense_solver(spark):
    rng = np.random.default_rng(7)
    rows = rng.standard_normal((300, 24)) @ np.diag(np.linspace(3, 0.3, 24)) + 5
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(rows)]
    check(whitening.whitening_report(make(spark, vectors)).collect(), vectors)


def test_edge_rows(spark):
    rng = np.random.default_rng(8)
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((40, 5)))]
    copies = [(100 + i, vectors[0][1]) for i in range(30)]  # a hot vector counts once
    bad = [
        (200, None), (201, []), (202, [None] * 5), (203, [1.0, float("nan"), 0.0, 0.0, 0.0]),
        (204, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (205, [1e30, 0.0, 0.0, 0.0, 0.0]), (206, [1.0, 2.0]),
    ]
    got = whitening.whitening_report(make(spark, vectors + copies + bad)).collect()
    check(got, vectors + copies + bad)
    ids = make(spark, vectors + [(None, vectors[3][1]), (0, vectors[0][1])])
    assert whitening.whitening_report(ids).count() == 42 * 5
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whitening_report(empty).count() == 0
    assert whitening.whitening_report(make(spark, copies)).count() == 0  # one distinct vector
    assert whitening.whitening_report(make(spark, bad[:6])).count() == 0


def test_repeated_and_missing_variances(spark):
    """Eight equal variances, two dimensions without any: the walk starts afresh for each."""
    vectors = []
    for d in range(8):
        for s in (-2.0, 2.0):
            vectors.append((len(vectors), [s if i == d else 0.0 for i in range(10)]))
    got = whitening.whitening_report(make(spark, vectors)).collect()
    assert len(got) == 16 * 8
    check(got, vectors, distinct_values=False)


@pytest.mark.parametrize("spectrum", [[5, 4, 3, 2, 1], [3, 3, 3, 1, 1], [2, 0, 0, 0, 0], [1e6, 1, 1e-3, 1e-5, 0]])
def test_bidiagonal_form(spectrum):
    """X V = U B holds with orthogonal V, whatever the variances."""
    rng = np.random.default_rng(3)
    u, _ = np.linalg.qr(rng.standard_normal((50, 5)))
    v, _ = np.linalg.qr(rng.standard_normal((5, 5)))
    x = u @ np.diag(spectrum) @ v

    def products(p):
        return x.T @ (x @ p), (x @ p) @ (x @ p)

    right, small = whitening.bidiagonal(products, 5, np.linalg.norm(x), 5)
    assert np.allclose(right @ right.T, np.eye(5), atol=1e-12)
    assert not np.tril(small, -1).any() and not np.triu(small, 2).any()
    assert np.allclose(np.linalg.svd(small)[1], sorted(spectrum, reverse=True), atol=1e-9 * max(spectrum))


def test_deviations_beyond_64_bits():
    centre = whitening.Centre(3, [3 * 2**40, 7])
    x = np.array([[2**52, 5], [2**40, 2]])
    assert centre.deviations(x) == [(3 * 2**52 - 3 * 2**40) ** 2 + 64, 1]

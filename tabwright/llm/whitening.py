"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The rows of the matrix X are the centred distinct vectors, spread over tasks in blocks. A step
sends one right vector v to all tasks, which form Xv and at once Xᵀ(Xv); only sums of the
length of a vector come back. Left vectors are never stored: each lies in the range of X, so
its coefficients (a vector p with u = Xp) stand for it, and full reorthogonalisation on both
sides works on vectors of that length. The small bidiagonal matrix is decomposed on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import scratch_path, small_table

from .common import record_batch

SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this lie outside the integer grid; their rows are left out.
LARGEST = float(2**30)
#: Vectors in a block; a block of 64 entries a vector has 2 MB.
BLOCK_ROWS = 4096
BLOCKS = "dims int, n long, sums array<long>, body binary"
WHITENED = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
    "explained double, identity_error double"
)


def grid_rows(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the usable rows, each entry on the integer grid.

    A row whose vector is null or empty, or holds a null, NaN, infinite or huge (over 2**30)
    entry, is left out.
    """
    vector = F.col("embedding").cast("array<double>")
    usable = F.forall(vector, lambda c: F.coalesce(F.abs(c) <= LARGEST, F.lit(False)))
    # NaN is above every number, so the comparison refuses it
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        .filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & usable)
        .select("vec_id", F.transform("vector", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))
    )


def matrix_of(batch, column="x"):
    """{length: (row numbers, matrix of integers)} of a column of integer lists."""
    lists = batch.column(column)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes := np.diff(lists.offsets.to_numpy()))
    found = {}
    for dims in np.unique(sizes):
        rows = np.flatnonzero(sizes == dims)
        if len(rows) == len(sizes):
            found[int(dims)] = rows, values.reshape(len(rows), dims)
        else:
            found[int(dims)] = rows, values[(ends[rows] - dims)[:, None] + np.arange(dims)]
    return found


def fit_blocks(rows: DataFrame) -> DataFrame:
    """Distinct vectors, packed: (dims, n, sums, body), body holding 64-bit integers row by row.

    Copies are combined in map tasks before the shuffle.
    """
    schema = pa.schema(
        [("dims", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("body", pa.binary())]
    )

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK_ROWS):
                for dims, (_, x) in matrix_of(whole.slice(start, BLOCK_ROWS)).items():
                    body = np.ascontiguousarray(x, "<i8").tobytes()
                    yield record_batch(schema, [[dims], [len(x)], [x.sum(0).tolist()], [body]])

    return rows.select("x").distinct().mapInArrow(run, BLOCKS)


@dataclass
class Fit:
    """Whitening of one table. ``components`` has a unit eigenvector a row, ``variances`` falls."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float


class Centre:
    """The mean of ``n`` integer vectors, kept as whole part and rest so nothing is rounded early."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Rows minus their mean."""
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of (n x - S)² of every row, exact at any size."""
        away = x - self.whole
        largest = (int(np.abs(away).max(initial=0)) + 1) * self.n
        if largest**2 * x.shape[1] < 2**63:
            return np.square(self.n * away - self.rest).sum(1).tolist()
        rest = self.rest.tolist()
        return [sum((self.n * v - r) ** 2 for v, r in zip(row, rest)) for row in away.tolist()]


def block_sums(blocks: DataFrame, width: int, work) -> np.ndarray:
    """Sum over all blocks of ``work(x)``, a vector of ``width`` numbers.

    Tasks add up their own blocks; their sums meet by place, so the driver gets ``width`` rows.
    """
    schema = pa.schema([("place", pa.int32()), ("value", pa.float64())])

    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            for dims, body in zip(batch["dims"].to_pylist(), batch["body"].to_pylist()):
                total += work(np.frombuffer(body, "<i8").reshape(-1, dims))
        yield record_batch(schema, [np.arange(width, dtype=np.int32), total])

    summed = blocks.select("dims", "body").mapInArrow(run, "place int, value double")
    found = np.zeros(width)
    for row in summed.groupBy("place").agg(F.sum("value").alias("value")).collect():
        found[row["place"]] = row["value"]
    return found


def bidiagonal(products, dims: int, scale: float, steps: int):
    """Right vectors (rows) and upper bidiagonal matrix of the centred rows.

    ``products(p)`` gives Xᵀ(Xp) and the squared length of Xp. Where the space is exhausted
    (a length of nearly zero) the walk goes on from a fresh right vector orthogonal to all
    earlier ones, so repeated variances are found as often as they occur.
    """
    rng = np.random.default_rng(dims)
    right, left, images, alphas, betas = [], [], [], [], []
    tiny = 1e-13 * scale

    def against(v, basis):
        for _ in range(2):
            for b in basis:
                v = v - (b @ v) * b
        return v

    def fresh():
        v = against(rng.standard_normal(dims), right)
        return against(v / np.linalg.norm(v), right)

    v, beta = fresh(), 0.0
    while True:
        v = v / np.linalg.norm(v)
        right.append(v)
        p = v - beta * left[-1] if beta else v.copy()
        image, square = products(p)
        for _ in range(2):  # u against all earlier left vectors, through uᵀXp = (image of u) · p
            for q, z in zip(left, images):
                c = z @ p
                p, image = p - c * q, image - c * z
        alpha = float(np.sqrt(max(p @ image, 0.0))) if left else float(np.sqrt(square))
        alphas.append(alpha if alpha > tiny else 0.0)
        if alpha > tiny:
            left.append(p / alpha)
            images.append(image / alpha)
            v = against(images[-1] - alpha * v, right)
            beta = float(np.linalg.norm(v))
        else:
            left.append(np.zeros(dims))
            images.append(np.zeros(dims))
            beta = 0.0
        if len(right) >= steps:
            break
        if beta <= tiny:
            v, beta = fresh(), 0.0
        betas.append(beta)
    k = len(right)
    return np.array(right), np.diag(alphas) + np.diag(betas[: k - 1], 1)


def fit_whitening(blocks: DataFrame, most: int = 16, steps: int | None = None) -> Fit | None:
    """Leading components of the packed distinct vectors; None without rows.

    If vectors have several lengths, the most frequent one counts (of equals the greatest).
    ``steps`` bounds the walk; by default it goes on until the space is exhausted, once for
    each dimension. Variances of nearly zero (1e-12 of the greatest) give no component.
    """
    kinds = blocks.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if kinds is None:
        return None
    dims, n = kinds["dims"], kinds["n"]
    blocks = blocks.filter(F.col("dims") == dims)
    summed = blocks.select(F.posexplode("sums").alias("place", "s")).groupBy("place").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    )
    sums = [int(s) for _, s in sorted(map(tuple, summed.collect()))]
    centre = Centre(n, sums)
    trace = block_sums(blocks, 1, lambda x: np.array([np.square(centre.rows(x)).sum()]))[0] / n
    if not trace:
        return Fit(n, sums, np.zeros((0, dims)), np.zeros(0), 0.0, 0.0)

    def products(p):
        def work(x):
            rows = centre.rows(x)
            u = rows @ p
            return np.append(rows.T @ u, u @ u)

        found = block_sums(blocks, dims + 1, work)
        return found[:-1], found[-1]

    right, small = bidiagonal(products, dims, np.sqrt(trace * n), min(steps or dims, dims))
    _, values, turn = np.linalg.svd(small)
    kept = int((values[:most] ** 2 > 1e-12 * values[0] ** 2).sum())
    components = turn[:kept] @ right
    components /= np.linalg.norm(components, axis=1)[:, None]
    variances = values[:kept] ** 2 / n

    def covariance(x):
        w = centre.rows(x) @ components.T / np.sqrt(variances)
        return (w.T @ w).ravel()

    found = block_sums(blocks, kept * kept, covariance).reshape(kept, kept) / n
    return Fit(n, sums, components, variances, trace, float(np.abs(found - np.eye(kept)).max()))


def whiten(embeddings: DataFrame, most: int = 16, steps: int | None = None) -> DataFrame:
    """One row per usable vector and component, numbered from 1 by falling variance.

    Repeated rows are whitened one by one and count once in the fit. Rows of another length
    than the most frequent one are left out. An empty table, or one distinct vector alone, has
    no component and so no rows. ``deviation`` is exact; ``whitened`` is the centred row
    projected on the component and divided by its deviation.
    """
    spark = embeddings.sparkSession
    rows = grid_rows(embeddings)
    path = scratch_path(spark, "distinct")
    fit_blocks(rows).write.option("compression", "zstd").parquet(path)
    blocks = spark.read.parquet(path).persist(StorageLevel.MEMORY_AND_DISK)
    fit = fit_whitening(blocks, most, steps)
    blocks.unpersist()
    if fit is None or not len(fit.variances):
        return small_table(spark, [], WHITENED)
    centre, dims, kept = Centre(fit.n, fit.sums), len(fit.sums), len(fit.variances)
    turn = fit.components.T / np.sqrt(fit.variances)
    explained = fit.variances / fit.trace
    schema = pa.schema(
        [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.decimal128(38, 0))]
        + [(c, pa.float64()) for c in ("whitened", "explained", "identity_error")]
    )

    def run(batches):
        import decimal

        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(start, BLOCK_ROWS)
                if dims not in (found := matrix_of(batch)):
                    continue
                places, x = found[dims]
                ids = batch["vec_id"].take(pa.array(np.repeat(places, kept)))
                away = pa.array(map(decimal.Decimal, centre.deviations(x)), pa.decimal128(38, 0))
                m = len(places)
                yield record_batch(
                    schema,
                    [
                        ids,
                        np.tile(np.arange(1, kept + 1, dtype=np.int32), m),
                        np.full(m * kept, centre.n),
                        away.take(pa.array(np.repeat(np.arange(m), kept))),
                        (centre.rows(x) @ turn).ravel(),
                        np.tile(explained, m),
                        np.full(m * kept, fit.identity_error),
                    ],
                )

    return rows.mapInArrow(run, WHITENED)


def whitening_report(embeddings: DataFrame) -> DataFrame:
    """``whiten`` with deviations as long; one that no long holds is null."""
    return whiten(embeddings).withColumn("deviation", F.col("deviation").try_cast("long"))

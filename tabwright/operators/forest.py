"""Random forests with unlimited depth and every distinct threshold.

Each tree draws its own rows (Poisson counts from a hash of row and tree) and, at every node,
its own features. Rows with equal features and label are counted first, so copies of a row
cost one. A table that fits ``subtree_bytes`` is sent to the tasks once and each task grows
whole trees. For a larger table Spark ML's forest grows the upper levels distributed, until
the rows below each of its leaves fit the same budget; then one task finishes each subtree
exactly. Growing and scoring run in the executors' JVM (``Trees.java``): the rows are sorted
once per feature and keep that order on their way down. ``grow_tree``, ``tree_shares`` and
``poisson`` are the same in numpy, and define the results.

The model is a table of subtrees. Scoring sends it to the tasks in blocks of at most
``block_bytes``. A forest of more than one block either takes one pass over the rows for each,
or stays where it is while the rows are sent to it, whichever is fewer passes.
"""

from __future__ import annotations

import math
import os
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.java import java_object, map_partitions
from tabwright.operators.rownum import number_rows
from tabwright.session import cut_lineage, scratch_path, shared_dir

# functions of this module that run in Python workers are shipped by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE = np.dtype([("feature", "<i4"), ("left", "<i4"), ("threshold", "<f8")])
SUBTREES = "tree int, leaf int, nodes binary, shares binary, size bigint"
#: Few, large rows: small row groups, checked after each, bound what a task holds of them;
#: thresholds do not compress.
STORED = {
    "compression": "uncompressed", "parquet.block.size": str(16 << 20),
    "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1",
}
JAVA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "Trees.java")
#: Bins and depth of the upper levels, which Spark ML grows.
UPPER_BINS = 256
DEEPEST = 30


@dataclass(frozen=True)
class ForestSpec:
    trees: int = 300
    seed: int = 42
    bootstrap: bool = True
    subtree_bytes: int = 64 << 20
    block_bytes: int = 256 << 20


#: Rows whose sums of class shares travel together when a forest is scored where it is.
PART = 1 << 16
#: Bytes of the rows sent to a forest at once, their sums included.
ROWS_BYTES = 64 << 20


def mix(values: np.ndarray, salt: int) -> np.ndarray:
    """Uniform 64-bit values from 64-bit values (the public SplitMix64 finaliser)."""
    x = values.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def poisson(rows: np.ndarray, copies: np.ndarray, salt: int) -> np.ndarray:
    """How often each row is drawn: Poisson with mean ``copies``, a function of row and salt.

    Means are taken in steps of 500, whose sums have the right distribution.
    """
    drawn = np.zeros(len(rows), np.int64)
    left, step = copies.astype(float), 0
    while (open_ := np.flatnonzero(left > 0)).size:
        mean = np.minimum(left[open_], 500.0)
        u = mix(rows[open_], salt * 1_000_003 + step) / 2.0**64
        term = np.exp(-mean)
        upto, k = term.copy(), 0
        above = np.flatnonzero(u >= upto)
        while above.size and k < 2000:
            k += 1
            drawn[open_[above]] += 1
            term[above] *= mean[above] / k
            upto[above] += term[above]
            above = above[(u[above] >= upto[above]) & (term[above] > 0)]
        left[open_] -= mean
        step += 1
    return drawn


def segment_best(score: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(greatest score, its first place) of every segment."""
    best = np.maximum.reduceat(score, starts)
    sizes = np.diff(np.append(starts, len(score)))
    at = np.flatnonzero(score == np.repeat(best, sizes))
    _, first = np.unique(np.searchsorted(starts, at, side="right"), return_index=True)
    return best, at[first]


def impurity_left(mass: np.ndarray) -> np.ndarray:
    """Sum of squares over the sum, class after class, as Trees.java adds them."""
    total, squares = np.zeros(len(mass)), np.zeros(len(mass))
    for own in mass.T:
        total += own
        squares += own * own
    with np.errstate(divide="ignore", invalid="ignore"):
        return squares / total


def grow_tree(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int, seed, class_weights=None
) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, class shares of leaves) of one tree on rows with positive weight.

    A node looks at the square root of the features, in random order, and at more until one
    can split it. The split with the least Gini impurity lies halfway between two values; the
    earlier feature and the smaller value win ties. Only pure nodes and rows that no feature
    tells apart are leaves. Leaves have feature -1 and, as ``left``, the row of their shares.
    Row weights are added up as they are, whole numbers exactly; those of the classes multiply
    the sums.
    """
    rng = np.random.default_rng(seed)
    n, width = x.shape
    looks = max(1, math.isqrt(width))
    per_class = np.ones(classes) if class_weights is None else np.asarray(class_weights, float)
    mass = np.zeros((n, classes))
    mass[np.arange(n), y] = weight
    rows, node = np.arange(n), np.zeros(n, np.int64)  # rows are kept in order of their node
    nodes, shares, known, made = [], [], {}, 1
    while rows.size:
        starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        m = len(starts)
        here = np.repeat(np.arange(m), np.diff(np.append(starts, len(rows))))
        totals = np.add.reduceat(mass[rows], starts, axis=0)
        values = x[rows]
        differs = np.maximum.reduceat(values, starts, axis=0) > np.minimum.reduceat(values, starts, axis=0)
        impure = (totals > 0).sum(1) > 1
        # the rank of every feature in the node's random order; constant ones may be drawn too
        rank = np.argsort(np.argsort(rng.random((m, width)), axis=1), axis=1)
        drawn = (rank < looks) & differs
        first = np.where(differs, rank, width).argmin(1)
        drawn[np.arange(m), first] |= ~drawn.any(1)
        drawn &= (differs.any(1) & impure)[:, None]
        gain = np.full(m, -np.inf)
        feature, threshold, order = np.full(m, -1), np.zeros(m), np.full(m, width)
        for f in np.flatnonzero(drawn.any(0)):
            part = np.flatnonzero(drawn[here, f])
            own = here[part]
            sort = part[np.lexsort((values[part, f], own))]
            v, own = values[sort, f], here[sort]
            begin = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            left = np.cumsum(mass[rows[sort]], axis=0)
            before = np.vstack([np.zeros((1, classes)), left])[begin]
            left -= np.repeat(before, np.diff(np.append(begin, len(sort))), axis=0)
            right = np.maximum(totals[own] - left, 0)
            score = impurity_left(left * per_class) + impurity_left(right * per_class)
            cut = np.append((own[1:] == own[:-1]) & (v[1:] > v[:-1]), False)
            best, at = segment_best(np.where(cut, score, -np.inf), begin)
            which = own[begin]
            # scores a rounding error apart are ties
            close = np.abs(best - gain[which]) <= 1e-12 * np.abs(best)
            better = np.where(close, rank[which, f] < order[which], best > gain[which])
            which, at = which[better], at[better]
            gain[which], feature[which], order[which] = best[better], f, rank[which, f]
            middle = v[at] / 2 + v[at + 1] / 2
            threshold[which] = np.where((middle >= v[at]) & (middle < v[at + 1]), middle, v[at])
        split = feature >= 0
        level = np.zeros(m, NODE)
        level["feature"], level["threshold"] = feature, threshold
        child = made + 2 * (np.cumsum(split) - 1)
        level["left"][split] = child[split]
        made += 2 * int(split.sum())
        ends = totals[~split] * per_class
        ends /= ends.cumsum(1)[:, -1:]
        places = []
        for share in ends:
            own = share.tobytes()
            if own not in known:
                known[own] = len(shares)
                shares.append(share)
            places.append(known[own])
        level["left"][~split] = places
        nodes.append(level)
        keep = split[here]
        rows, here = rows[keep], here[keep]
        goes = x[rows, feature[here]] > threshold[here]
        node = child[here] + goes
        sort = np.argsort(node, kind="stable")
        rows, node = rows[sort], node[sort]
    return np.concatenate(nodes), np.array(shares).reshape(len(shares), classes)


def tree_shares(x: np.ndarray, nodes: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Class shares of the leaf that each row reaches."""
    at = np.zeros(len(x), np.int64)
    open_ = np.arange(len(x))
    while open_.size:
        own = nodes[at[open_]]
        inner = own["feature"] >= 0
        open_, own = open_[inner], own[inner]
        at[open_] = own["left"] + (x[open_, own["feature"]] > own["threshold"])
    return shares[nodes["left"][at]]


def unpack_nodes(packed: bytes) -> np.ndarray:
    """Nodes from their stored form: counts and code sizes, one bit a node (it splits), then the
    features and thresholds of those that split and the share rows of the others.

    Children stand side by side in the order of their parents, so their places are not stored.
    """
    n, inner, f, l = np.frombuffer(packed, "<i4", 4).tolist()
    at = 16 + (n + 7) // 8
    split = np.unpackbits(np.frombuffer(packed, np.uint8, at - 16, 16), count=n, bitorder="little").astype(bool)
    nodes = np.zeros(n, NODE)
    nodes["feature"] = -1
    nodes["feature"][split] = np.frombuffer(packed, f"<u{f}", inner, at)
    nodes["threshold"][split] = np.frombuffer(packed, "<f8", inner, at + inner * f)
    nodes["left"][split] = 1 + 2 * np.arange(inner)
    nodes["left"][~split] = np.frombuffer(packed, f"<u{l}", n - inner, at + inner * (f + 8))
    return nodes


def lists_matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists of numbers as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


@dataclass(frozen=True)
class Forest:
    """A table of subtrees at ``path``; ``upper`` says whether the pipeline gives leaves."""

    path: str
    trees: int
    classes: int
    upper: bool = False
    block_bytes: int = ForestSpec.block_bytes

    def description(self) -> dict:
        return {"trees": self.trees, "classes": self.classes, "upper": self.upper, "block_bytes": self.block_bytes}

    def table(self, spark) -> tuple[DataFrame, bool]:
        """(subtrees, whether their nodes are packed); tables without sizes hold plain ``NODE`` rows."""
        found = spark.read.parquet(self.path)
        if "size" in found.columns:
            return found, True
        return found.withColumn("size", F.octet_length("nodes") + F.octet_length("shares")), False

    def blocks(self, spark) -> list[list[int]]:
        """Trees in groups whose subtrees have at most ``block_bytes``, one tree at least."""
        sizes = self.table(spark)[0].groupBy("tree").agg(F.sum("size").alias("size"))
        groups, filled = [], math.inf
        for tree, size in sorted(map(tuple, sizes.collect())):
            if filled + size > self.block_bytes:
                groups.append([])
                filled = 0
            groups[-1].append(tree)
            filled += size
        return groups

    def add_probabilities(self, df: DataFrame) -> DataFrame:
        """``probability``, the mean class shares over all trees, and ``prediction``.

        Reads ``tw_features``, and ``tw_leaves`` where upper levels were grown apart.
        """
        groups = self.blocks(df.sparkSession)
        if len(groups) > 1 and df.isStreaming:
            raise ValueError("a stream needs a forest of one block; raise block_bytes")
        names = df.columns
        if len(groups) == 1:
            df = df.withColumn("tw_mass", self.added_shares(df.sparkSession, groups[0]))
        else:
            df = self.many_blocks(df, groups)
        shares = F.transform("tw_mass", lambda v: v / self.trees)
        place = F.array_position("probability", F.array_max("probability")) - 1
        return df.withColumn("probability", shares).select(
            *[F.col("`" + c.replace("`", "``") + "`") for c in names],
            "probability",
            place.cast("double").alias("prediction"),
        )

    def added_shares(self, spark, trees: list[int]) -> Column:
        """Class shares added up over some trees, which are broadcast."""
        table, packed = self.table(spark)
        add = java_object(spark, JAVA, "tabwright.AddShares")
        rows = table.filter(F.col("tree").isin(trees))._jdf.collectAsList()
        add.setup(spark.sparkContext._jsc.broadcast(add.block(rows)), self.classes, packed)
        inputs = [F.col("tw_features"), F.col("tw_leaves") if self.upper else F.lit(None)]
        columns = spark._jvm.PythonUtils.toSeq([c._jc for c in inputs])
        return Column(add.function().apply(columns))

    def many_blocks(self, df: DataFrame, groups: list[list[int]]) -> DataFrame:
        """``df`` with ``tw_mass``: the rows go to the trees where that takes fewer passes."""
        fixed = number_rows(df, "tw_number")
        sizes = fixed.agg(F.count("*").alias("n"), F.first("tw_features").alias("x")).first()
        rows = sizes["n"]
        if not rows:
            return df.withColumn("tw_mass", F.array_repeat(F.lit(0.0), self.classes))
        most = max(1, ROWS_BYTES // (8 * (sizes["x"].size + self.classes)))
        if self.upper or math.ceil(rows / most) > len(groups):
            total = None
            for trees in groups:
                own = self.added_shares(df.sparkSession, trees)
                if total is not None:
                    own = F.zip_with("tw_mass", own, lambda a, b: a + b)
                total = cut_lineage((fixed if total is None else total).withColumn("tw_mass", own))
            return total
        path = scratch_path(df.sparkSession, "mass")
        for start in range(0, rows, most):
            sums = self.summed(fixed, start, min(most, rows - start))
            sums.write.mode("append").parquet(path)
        return fixed.join(df.sparkSession.read.parquet(path), "tw_number")

    def summed(self, fixed: DataFrame, start: int, rows: int) -> DataFrame:
        """(tw_number, tw_mass) of ``rows`` rows from number ``start``, which are broadcast."""
        spark = fixed.sparkSession
        own = fixed.filter((F.col("tw_number") >= start) & (F.col("tw_number") < start + rows))
        x = vector_to_array("tw_features").alias("x")
        score = java_object(spark, JAVA, "tabwright.ScoreRows")
        block = score.block(packed_rows(own.select(F.col("tw_number").alias("number"), x)), start, rows)
        table, packed = self.table(spark)
        score.setup(spark.sparkContext._jsc.broadcast(block), self.classes, PART, packed)
        # every task of this stage sends sums of all rows
        trees = table.select("nodes", "shares").coalesce(spark.sparkContext.defaultParallelism)
        parts = map_partitions(trees, score, "number bigint, sums binary")
        add = java_object(spark, JAVA, "tabwright.SumParts").setup(self.classes)
        return map_partitions(parts.repartition("number"), add, "tw_number bigint, tw_mass array<double>")


def packed_rows(df: DataFrame):
    """The rows of ``df`` in the driver's JVM, the bytes of every column for some rows at a time."""
    pack = java_object(df.sparkSession, JAVA, "tabwright.PackRows")
    return map_partitions(df, pack, ", ".join(f"{c} binary" for c in df.columns))._jdf.collectAsList()


def counted_rows(matrix: DataFrame, *leaves) -> DataFrame:
    """(x, label, leaves, copies, row): rows with equal features and label counted together."""
    x = vector_to_array("tw_features").alias("x")
    rows = matrix.select(x, F.col("tw_label").cast("int").alias("label"), *leaves)
    keys = ["x", "label", *(["leaves"] if leaves else [])]
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).withColumn("row", F.xxhash64("x", "label"))


def fit_forest(matrix: DataFrame, weights: list[float], spec: ForestSpec):
    """(forest, stages): subtrees of all trees, and the fitted upper levels if there are any.

    ``matrix`` has ``tw_features``, ``tw_label`` and ``tw_weight``; ``weights`` are those of
    the classes.
    """
    spark = matrix.sparkSession
    path = scratch_path(spark, "rows")
    counted_rows(matrix).write.parquet(path)
    rows = spark.read.parquet(path)
    head = rows.first()
    if head is None:
        raise ValueError("there are no rows to grow trees on")
    row_bytes = 8 * len(head["x"]) + 24
    most = max(1, spec.subtree_bytes // row_bytes)
    count = rows.count()
    out = scratch_path(spark, "forest")
    if count <= most:
        grown, stages = whole_trees(rows, weights, spec), []
    else:
        upper, leaves = upper_levels(matrix, spec, count, most)
        grown, stages = finished_trees(leaves, weights, spec, row_bytes), [upper]
    grown.write.options(**STORED).parquet(out)
    return Forest(out, spec.trees, len(weights), bool(stages), spec.block_bytes), stages


def whole_trees(rows: DataFrame, weights, spec: ForestSpec) -> DataFrame:
    """Every tree in a task of its own; the counted rows, of checked size, are broadcast."""
    spark = rows.sparkSession
    grow = java_object(spark, JAVA, "tabwright.GrowTrees")
    table = grow.table(packed_rows(rows.select("x", "label", "copies", "row")))
    grow.setup(spark.sparkContext._jsc.broadcast(table), [float(w) for w in weights], spec.seed, spec.bootstrap)
    tasks = min(spec.trees, 4 * spark.sparkContext.defaultParallelism)
    return map_partitions(spark.range(0, spec.trees, 1, tasks).toDF("tree"), grow, SUBTREES)


def upper_levels(matrix: DataFrame, spec: ForestSpec, count: int, most: int):
    """(fitted Spark ML forest, counted rows with their leaf in every tree), grown until no
    leaf has more than ``most`` counted rows."""
    shared_dir(matrix.sparkSession)
    depth = math.ceil(math.log2(count / most)) + 1
    while depth <= DEEPEST:
        fitted = RandomForestClassifier(
            featuresCol="tw_features", labelCol="tw_label", weightCol="tw_weight", leafCol="tw_leaves",
            predictionCol="tw_upper", probabilityCol="tw_upper_share", rawPredictionCol="tw_upper_raw",
            numTrees=spec.trees, maxDepth=depth, maxBins=UPPER_BINS, featureSubsetStrategy="sqrt",
            seed=spec.seed, cacheNodeIds=True,
        ).fit(matrix)
        path = scratch_path(matrix.sparkSession, "leaves")
        leaves = F.transform(vector_to_array("tw_leaves"), lambda v: v.cast("int")).alias("leaves")
        counted_rows(fitted.transform(matrix), leaves).write.parquet(path)
        rows = matrix.sparkSession.read.parquet(path)
        largest = (
            rows.select(F.posexplode("leaves").alias("tree", "leaf"))
            .groupBy("tree", "leaf")
            .agg(F.count("*").alias("n"))
            .agg(F.max("n"))
            .first()[0]
        )
        if largest <= most:
            return fitted, rows
        depth += max(1, math.ceil(math.log2(largest / most)))
    raise ValueError("30 levels do not divide the rows; raise subtree_bytes")


def finished_trees(rows: DataFrame, weights, spec: ForestSpec, row_bytes: int) -> DataFrame:
    """One task for the rows below a leaf of an upper tree; rows travel packed by tree and leaf."""
    block = max(1, (8 << 20) // row_bytes)
    kinds = "tree int, leaf int, row binary, x binary, label binary, copies binary"

    def deal(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                x = lists_matrix(part["x"])
                leaves = lists_matrix(part["leaves"])
                row, label, copies = (part[c].to_numpy(zero_copy_only=False) for c in ("row", "label", "copies"))
                for tree in range(leaves.shape[1]):
                    drawn = np.ones(len(row), bool)
                    if spec.bootstrap:
                        drawn = poisson(row, copies, spec.seed * 100_003 + tree) > 0
                    out = []
                    for leaf in np.unique(leaves[:, tree]):
                        own = np.flatnonzero((leaves[:, tree] == leaf) & drawn)
                        if not own.size:  # the leaf must have a subtree even if it draws no row
                            own = np.flatnonzero(leaves[:, tree] == leaf)[:1]
                        pick = [a[own].tobytes() for a in (row, x, label.astype("<i4"), copies)]
                        out.append((tree, int(leaf), *pick))
                    arrays = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int32()] * 2 + [pa.binary()] * 4)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["tree", "leaf", "row", "x", "label", "copies"])

    grow = java_object(rows.sparkSession, JAVA, "tabwright.GrowTrees")
    grow.setup(None, [float(w) for w in weights], spec.seed, spec.bootstrap)
    dealt = rows.select("x", "label", "leaves", "copies", "row").mapInArrow(deal, kinds)
    return map_partitions(dealt.repartition("tree", "leaf").sortWithinPartitions("tree", "leaf"), grow, SUBTREES)

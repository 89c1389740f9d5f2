"""Merkle manifest of a table: a postorder log written by aligned builders, and its proofs.

Every row is a leaf, every tree has a fan-out of eight, and a node's digest is the SHA-256 of
its children's hex digests. A tree is cut into aligned blocks of ``8 ** LEVELS`` leaves. A
builder takes one block and appends leaves and nodes in completion order, which is postorder;
the tops of the blocks are the leaves of the next tier, until one top is left. Where a node
lies in a log follows from the sizes of the subtrees before it alone (``position``), so proofs
read siblings by address and no pointers are stored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.schema import quoted
from tabwright.session import cut_lineage, scratch_path, settle_any, small_table

from .common import record_batch

FAN_OUT = 8
#: Tree levels a builder closes; a block holds 8 ** 3 = 512 leaves.
LEVELS = 3
BLOCK = FAN_OUT**LEVELS
#: Fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEPS = "array<struct<before:string,after:string>>"
PATH = f"subroot string, root string, steps {STEPS}"
PROVEN = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves of a tree: runs of eight are joined while several nodes remain."""
    levels = 0
    while leaves > 1:
        leaves = -(-leaves // FAN_OUT)
        levels += 1
    return levels


def position(level: int, index: int, leaves: int) -> int:
    """Where the postorder log of a tree with ``leaves`` leaves holds node ``index`` of a level.

    Before leaf ``j`` come ``j`` leaves and ``j // 8 ** k`` complete nodes of every level ``k``;
    a node follows its last leaf by ``level`` places.
    """
    place = last = min((index + 1) * FAN_OUT**level, leaves) - 1
    while last := last // FAN_OUT:
        place += last
    return place + level


def append_log(leaves: list[str], levels: int) -> list[str]:
    """Hex digests of leaves and nodes in completion order; children are read by address."""
    log, n = [], len(leaves)

    def close(level, index):
        first = FAN_OUT * index
        under = -(-n // FAN_OUT ** (level - 1))
        kids = range(first, min(first + FAN_OUT, under))
        log.append(sha("".join(log[position(level - 1, c, n)] for c in kids)))

    for j, leaf in enumerate(leaves):
        log.append(leaf)
        for level in range(1, levels + 1):
            if (j + 1) % FAN_OUT**level and j + 1 < n:
                break
            close(level, j // FAN_OUT**level)
    return log


def block_levels(leaves: int, block: int) -> int:
    """Only a block that is a whole tree may be lower than the others."""
    return height(leaves) if block == 0 else LEVELS


def block_steps(log: list[str], leaves: int, levels: int) -> list[list[tuple[str, str]]]:
    """For every leaf of a block: the digests before and after it in its run, level by level."""
    by_level = []
    for level in range(levels):
        width = -(-leaves // FAN_OUT**level)
        found = []
        for first in range(0, width, FAN_OUT):
            run = [log[position(level, i, leaves)] for i in range(first, min(first + FAN_OUT, width))]
            found += [("".join(run[:i]), "".join(run[i + 1 :])) for i in range(len(run))]
        by_level.append(found)
    return [
        [by_level[level][j // FAN_OUT**level] for level in range(levels)] for j in range(leaves)
    ]


def fold(digest: str, steps) -> str:
    for before, after in steps:
        digest = sha(before + digest + after)
    return digest


def hexes(digests: list[bytes]) -> list[str]:
    return [d.hex() for d in digests]


def field_bytes(column):
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digests(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, altered): digests of every row and of its tampered form, else null.

    Where 3 divides the CRC-32 of the decimal id, tampering lower-cases A-Z of the text. All of
    it are JVM expressions. A null id is never tampered with.
    """
    values = {c: F.col(c) for c in FIELDS}
    lower = F.translate(F.col("text").cast("string"), UPPER, LOWER)

    def digest(text):
        parts = [field_bytes(text if c == "text" else values[c]) for c in FIELDS]
        return F.unhex(F.sha2(F.concat(*parts), 256))

    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(
        F.col("lang").cast("string").alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(F.col("text")).alias("leaf"),
        F.when(hit, digest(lower)).alias("altered"),
    )


def ranked(frame: DataFrame, order) -> DataFrame:
    """Add ``rank``, from 0 within ``tree`` in the given order, nulls first.

    One range sort over all trees, so a hot tree spreads over tasks, as do copies of a row. A
    row's rank is its place among the rows of its tree in its partition plus those in earlier
    partitions; the table of these sums has a row per partition and tree in it.
    """
    mark = F.monotonically_increasing_id()
    dealt = frame.withColumn("mark", mark).sort("tree", *order, "mark").drop("mark")
    marked = cut_lineage(dealt.withColumn("mark", mark))
    part = F.shiftright("mark", 33).alias("part")
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts, rows = settle_any(
        marked.groupBy(part, "tree")
        .agg(F.min("mark").alias("first"), F.count("*").alias("n"))
        .select(
            F.col("part").alias("own_part"),
            F.col("tree").alias("own_tree"),
            (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        )
    )
    starts = F.broadcast(starts) if rows <= 50_000 else starts
    same = (F.shiftright("mark", 33) == F.col("own_part")) & F.col("tree").eqNullSafe(
        F.col("own_tree")
    )
    return marked.join(starts, same).select(
        *[quoted(c) for c in frame.columns], (F.col("mark") + F.col("shift")).alias("rank")
    )


def blocks_of(members: DataFrame, *carried: str) -> DataFrame:
    """(tree, block, digests, ...): one row per aligned block, its members in order of rank."""
    block = F.expr(f"rank div {BLOCK}")
    packed = F.sort_array(F.collect_list(F.struct("rank", "digest", *carried)))
    return (
        members.groupBy("tree", block.alias("block"))
        .agg(packed.alias("m"))
        .select("tree", "block", F.col("m.digest").alias("digests"), *[F.col(f"m.{c}") for c in carried])
    )


def tops_of(blocks: DataFrame) -> DataFrame:
    """(tree, block, top): the last entry of every block's log."""
    schema = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("top", pa.binary())])

    def run(batches):
        for batch in batches:
            tops = []
            for block, digests in zip(batch["block"].to_pylist(), batch["digests"].to_pylist()):
                log = append_log(hexes(digests), block_levels(len(digests), block))
                tops.append(bytes.fromhex(log[-1]))
            yield record_batch(schema, [batch["tree"], batch["block"], tops])

    return blocks.select("tree", "block", "digests").mapInArrow(run, "tree string, block long, top binary")


@dataclass
class Forest:
    """Blocks of every tier of all trees, lowest first, and the one top of each tree."""

    tiers: list[DataFrame]
    roots: DataFrame


def grow(leaf_blocks: DataFrame) -> Forest:
    """Tiers above the blocks of leaves; a tier has a row for 512 of the tier below."""
    tiers = [leaf_blocks]
    while True:
        tops = cut_lineage(tops_of(tiers[-1]))
        last = tops.agg(F.max("block")).first()[0]
        if not last:
            return Forest(tiers, tops.select("tree", "top"))
        tiers.append(
            cut_lineage(blocks_of(tops.select("tree", F.col("block").alias("rank"), F.col("top").alias("digest"))))
        )


def paths_below(tier: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, block, subroot, root, steps) of the blocks one tier below, from those of ``tier``."""
    step = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    schema = pa.schema(
        [("tree", pa.string()), ("block", pa.int64()), ("subroot", pa.string()), ("root", pa.string()), ("steps", step)]
    )

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n, block = len(row["digests"]), row["block"]
                levels = block_levels(n, block)
                steps = block_steps(append_log(hexes(row["digests"]), levels), n, levels)
                yield record_batch(
                    schema,
                    [
                        [row["tree"]] * n,
                        [block * BLOCK + j for j in range(n)],
                        [row["subroot"]] * n,
                        [row["root"]] * n,
                        [[{"before": b, "after": a} for b, a in own] + row["steps"] for own in steps],
                    ],
                )

    return with_paths(tier, above).mapInArrow(run, f"tree string, block long, {PATH}")


def with_paths(tier: DataFrame, above: DataFrame) -> DataFrame:
    other = above.withColumnsRenamed({"tree": "own_tree", "block": "own_block"})
    same = F.col("tree").eqNullSafe(F.col("own_tree")) & (F.col("block") == F.col("own_block"))
    return tier.join(other, same).drop("own_tree", "own_block")


def paths_of_trees(roots: DataFrame) -> DataFrame:
    """(tree, block 0, subroot, root, steps): every tree's top as a leaf of the tree of trees."""
    spark = roots.sparkSession
    leaves = roots.select(
        F.lit("all").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest")
    )
    numbered = cut_lineage(ranked(leaves, ["name"]))
    forest = grow(blocks_of(numbered))
    top = forest.roots.select(F.lower(F.hex("top"))).first()[0]
    paths = small_table(spark, [("all", 0, "", top, [])], f"tree string, block long, {PATH}")
    for tier in reversed(forest.tiers):
        paths = paths_below(tier, paths)
    # after the lowest tier, a path belongs to a leaf: its block is the rank of the tree
    own = paths.select(F.col("block").alias("rank"), "root", "steps")
    return numbered.join(own, "rank").select(
        F.col("name").alias("tree"),
        F.lit(0).cast("long").alias("block"),
        F.lower(F.hex("digest")).alias("subroot"),
        "root",
        "steps",
    )


def leaf_forest(docs: DataFrame) -> Forest | None:
    """The trees of a table, one per language; None for a table without rows.

    Leaves of equal language and id are ordered by digest. The digests are written once (a few
    dozen bytes a row), then sorted; texts are read once and never shuffled.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "leaves")
    leaf_digests(docs).write.parquet(path)
    numbered = ranked(spark.read.parquet(path), ["doc_id", "leaf"])
    path = scratch_path(spark, "blocks")
    blocks_of(numbered.withColumnRenamed("leaf", "digest"), "doc_id", "altered").write.parquet(path)
    blocks = spark.read.parquet(path)
    return None if blocks.isEmpty() else grow(blocks)


def proof_report(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of every row, and the root folded from its tampered form.

    Nulls have their own mark in a leaf. Repeated rows are leaves of their own; repeated ids of
    one language are ordered by digest. An empty table has no rows and no root.
    """
    forest = leaf_forest(docs)
    if forest is None:
        return small_table(docs.sparkSession, [], PROVEN)
    paths = cut_lineage(paths_of_trees(forest.roots))
    for tier in reversed(forest.tiers[1:]):
        paths = paths_below(tier, paths)
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
        + [("verified", pa.bool_())]
    )

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                leaves, n = hexes(row["digests"]), len(row["digests"])
                levels = block_levels(n, row["block"])
                own = block_steps(append_log(leaves, levels), n, levels)
                above = [(s["before"], s["after"]) for s in row["steps"]]
                rest = "".join(b + a for b, a in above)
                proofs, folded = [], []
                for leaf, altered, steps in zip(leaves, row["altered"], own):
                    proofs.append(sha("".join(b + a for b, a in steps) + rest))
                    start = leaf if altered is None else altered.hex()
                    folded.append(fold(fold(start, steps), above))
                root = row["root"]
                yield record_batch(
                    schema,
                    [row["doc_id"], leaves, [row["subroot"]] * n, [root] * n, proofs, folded, [f == root for f in folded]],
                )

    return with_paths(forest.tiers[0], paths).mapInArrow(run, PROVEN)


def manifest_log(docs: DataFrame) -> DataFrame:
    """(tree, position, level, node, digest): the whole postorder log of every tree.

    Each tier's builders add the levels they close; a node's place in its tree's log follows
    from the number of leaves, whichever builder wrote it. An empty table has no rows.
    """
    kinds = "tree string, position long, level int, node long, digest string"
    forest = leaf_forest(docs)
    if forest is None:
        return small_table(docs.sparkSession, [], kinds)
    sizes = forest.tiers[0].groupBy(F.col("tree").alias("own_tree")).agg(
        F.sum(F.size("digests")).alias("leaves")
    )
    sizes = cut_lineage(sizes)
    out = None
    schema = pa.schema(
        [("tree", pa.string()), ("position", pa.int64()), ("level", pa.int32()), ("node", pa.int64()), ("digest", pa.string())]
    )
    for number, tier in enumerate(forest.tiers):

        def run(batches, base=number * LEVELS):
            for batch in batches:
                for row in batch.to_pylist():
                    n, block = len(row["digests"]), row["block"]
                    log = append_log(hexes(row["digests"]), block_levels(n, block))
                    places = []
                    # the leaves of higher tiers are the tops that the tier below wrote
                    for level in range(1 if base else 0, block_levels(n, block) + 1):
                        for i in range(-(-n // FAN_OUT**level)):
                            node = block * FAN_OUT ** (LEVELS - level) + i
                            where = position(base + level, node, row["leaves"])
                            places.append((row["tree"], where, base + level, node, log[position(level, i, n)]))
                    if places:
                        yield record_batch(schema, zip(*places))

        sized = tier.join(sizes, F.col("tree").eqNullSafe(F.col("own_tree")))
        written = sized.select("tree", "block", "digests", "leaves").mapInArrow(run, kinds)
        out = written if out is None else out.unionByName(written)
    return out

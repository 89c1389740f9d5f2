"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.session import cut_lineage

from .common import id_and_bytes, own_columns, record_batch, shuffle_partitions, slices
from .components import component_labels

#: Segments of a 64-bit fingerprint as (first bit, bits, radius). Two fingerprints that
#: differ in 4 bits or fewer agree up to the radius in one segment at least: beyond the
#: radii in all three they would differ in 2 + 2 + 1 bits.
SEGMENTS = ((0, 21, 1), (21, 21, 1), (42, 22, 0))


def fingerprint(body: bytes, shingle: int = 4) -> np.ndarray:
    """Hashes of the word shingles of a lower-cased text, repeats included."""
    from xxhash import xxh64_intdigest

    words = body.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - shingle + 1)
    stops = ends[min(shingle, len(words)) - 1 :]
    return np.array(
        [
            xxh64_intdigest(joined[a:b], 42)
            for a, b in zip(starts[:last].tolist(), stops.tolist())
        ],
        np.uint64,
    )


def majority_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """For each array of hashes, the 64-bit value of the bits set in over half of them."""
    out = np.zeros(len(hashes), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for at, own in enumerate(hashes):
        if len(own):
            bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = bits.sum(axis=0, dtype=np.int64)
            out[at] = weights[2 * ones > len(own)].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): the SimHash of every whole text as a signed long; no word gives 0."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for part in slices(batches):
            found = majority_bits(
                [fingerprint(body, shingle) for body in part.column(1).to_pylist()]
            )
            yield record_batch(schema, [part.column(0), found.view(np.int64)])

    return id_and_bytes(docs).mapInArrow(run, "doc_id long, fp long")


def _segment(fp, first: int, bits: int):
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _keys(segment: int, value):
    return F.lit(segment << 32).cast("long").bitwiseOR(value)


def table_keys(fp) -> T.ArrayType:
    """The exact key of each segment: what a fingerprint is filed under."""
    return F.array(
        *(_keys(i, _segment(fp, first, bits)) for i, (first, bits, _) in enumerate(SEGMENTS))
    )


def ball_keys(fp):
    """All keys within each segment's radius: where a fingerprint looks for others."""
    keys = []
    for i, (first, bits, radius) in enumerate(SEGMENTS):
        own = _segment(fp, first, bits)
        keys.append(_keys(i, own))
        if radius:
            keys += [
                _keys(i, own.bitwiseXOR(F.lit(1 << bit).cast("long"))) for bit in range(bits)
            ]
    return F.array(*keys)


def _spanning(table: np.ndarray, probe: np.ndarray, most: int):
    """Edges that connect what links inside one bucket, without listing all its pairs.

    A breadth-first search over the bucket's table and probing sides: whoever has been
    reached leaves the set that later steps compare with, so a tight group is taken in few
    steps and gives one edge per member.
    """
    left = [np.unique(table), np.unique(probe)]
    edges = []
    while len(left[0]) and len(left[1]):
        front, side = left[0][:1], 0
        left[0] = left[0][1:]
        queue = [(side, front)]
        while queue:
            side, front = queue.pop()
            other = 1 - side
            for one in front:
                near = np.bitwise_count(left[other] ^ one) <= most
                if near.any():
                    found = left[other][near]
                    left[other] = left[other][~near]
                    edges.append(np.stack([np.full(len(found), one), found]))
                    queue.append((other, found))
    return edges


def _bucket_edges(keys, fps, is_table, most: int):
    """Verified edges among the rows of whole buckets, sorted by key."""
    out = []
    order = np.lexsort((~is_table, keys))
    keys, fps, is_table = keys[order], fps[order], is_table[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(heads, len(keys)))
    tables = np.add.reduceat(is_table.astype(np.int64), heads)
    probes = sizes - tables
    pairs = tables * probes
    small = (pairs > 0) & (pairs <= 4096)
    # all pairs of small buckets at once, in runs of about a million
    chosen = np.flatnonzero(small)
    ends = np.cumsum(pairs[chosen])
    at = 0
    while at < len(chosen):
        upto = np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20)) + 1
        part = chosen[at:upto]
        count = pairs[part]
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        wide = np.repeat(probes[part], count)
        head = np.repeat(heads[part], count)
        a = fps[head + inner // wide]
        b = fps[head + np.repeat(tables[part], count) + inner % wide]
        near = (np.bitwise_count(a ^ b) <= most) & (a != b)
        out.append(np.stack([a[near], b[near]]))
        at = upto
    for i in np.flatnonzero(pairs > 4096):
        cut = heads[i] + tables[i]
        out += _spanning(fps[heads[i] : cut], fps[cut : heads[i] + sizes[i]], most)
    return out


def _find_edges(most: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges_of(keys, fps, is_table):
        found = _bucket_edges(keys, fps.view(np.uint64), is_table, most)
        if found:
            both = np.concatenate(found, axis=1)
            both = both[:, both[0] != both[1]].view(np.int64)
            low, high = both.min(axis=0), both.max(axis=0)
            pairs = np.unique(np.stack([low, high]), axis=1)
            if pairs.shape[1]:
                yield record_batch(schema, [pairs[0], pairs[1]])

    def run(batches):
        held: list = []

        def gathered():
            return [np.concatenate(x) for x in zip(*held)]

        for batch in batches:
            now = [
                batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)
            ]
            if not len(now[0]):
                continue
            if held and held[-1][0][-1] != now[0][-1] and sum(len(x[0]) for x in held) > 100_000:
                # every bucket but the last one is complete
                keys, fps, flags = gathered()
                whole = keys != keys[-1]
                yield from edges_of(keys[whole], fps[whole], flags[whole])
                held = [(keys[~whole], fps[~whole], flags[~whole])]
            held.append(now)
        if held:
            yield from edges_of(*gathered())

    return run


def fingerprint_edges(prints: DataFrame, most: int = 4, block: int = 8192) -> DataFrame:
    """(a, b): links among distinct fingerprints ``fp`` that connect all within ``most`` bits.

    Fingerprints are filed under three exact segment keys and look for partners under every
    key of a small Hamming ball. Buckets meet in one task each; a bucket with more than
    ``block`` filed or probing fingerprints is dealt as blocks, each block of filed ones
    against each block of probing ones, so no task holds an unbounded bucket. Every match is
    verified over all 64 bits.
    """
    if most != 4:
        raise ValueError("the segments are laid out for 4 differing bits")
    filed = prints.select(F.explode(table_keys(F.col("fp"))).alias("key"), "fp")
    crowded = cut_lineage(
        filed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") * 64 > block)
    )
    rows = filed.withColumn("is_table", F.lit(True)).union(
        prints.select(
            F.explode(ball_keys(F.col("fp"))).alias("key"), "fp", F.lit(False).alias("is_table")
        )
    )
    if crowded.head(1):
        rows = _deal_crowded(rows, crowded, block)
    else:
        rows = rows.withColumn("cell", F.col("key"))
    return (
        rows.select("cell", "fp", "is_table")
        .repartition(shuffle_partitions(prints.sparkSession), "cell")
        .sortWithinPartitions("cell")
        .mapInArrow(_find_edges(most), "a long, b long")
    )


def _deal_crowded(rows: DataFrame, crowded: DataFrame, block: int) -> DataFrame:
    """Split the buckets whose filed or probing side may exceed ``block`` into block pairs."""
    seg, value = F.shiftright("key", 32), F.col("key").bitwiseAND(F.lit((1 << 32) - 1))
    around = F.lit(None)
    for i, (_, bits, radius) in enumerate(SEGMENTS):
        ball = [value] + [
            value.bitwiseXOR(F.lit(1 << b).cast("long")) for b in range(bits) if radius
        ]
        around = F.when(seg == i, F.array(*(_keys(i, v) for v in ball))).otherwise(around)
    probing = (
        crowded.select(F.explode(around).alias("key"), "n")
        .groupBy("key")
        .agg((F.sum("n") + F.lit(block // 2)).alias("p"))
    )
    plan = (
        probing.join(crowded, "key", "left")
        .select(
            F.col("key").alias("hot"),
            F.ceil(F.coalesce("n", F.lit(1)) / block).cast("int").alias("nt"),
            F.ceil(F.col("p") / block).cast("int").alias("np"),
        )
        .filter("nt > 1 or np > 1")
    )
    plan = cut_lineage(plan)
    if plan.count() <= 100_000:  # checked size: 16 bytes a row
        plan = F.broadcast(plan)
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("is_table"), F.col("nt")).otherwise(F.col("np")))
    other = F.when(F.col("is_table"), F.col("np")).otherwise(F.col("nt"))
    cells = F.transform(
        F.sequence(F.lit(0), other - 1),
        lambda j: F.when(
            F.col("is_table"), F.xxhash64("key", own.cast("int"), j)
        ).otherwise(F.xxhash64("key", j, own.cast("int"))),
    )
    return rows.join(plan, rows["key"] == plan["hot"], "left").select(
        "fp",
        "is_table",
        F.explode(
            F.when(F.col("hot").isNull(), F.array("key")).otherwise(cells)
        ).alias("cell"),
    )


def near_duplicate_components(docs: DataFrame, shingle: int = 4, most: int = 4) -> DataFrame:
    """One row per document: its SimHash and the least doc_id reachable over links.

    Texts link when their fingerprints differ in ``most`` bits or fewer; a text without
    words has fingerprint zero and links like any other. Equal fingerprints are collapsed
    before any search, so copies cost one row each. Repeated rows keep their own rows. A
    null doc_id takes part in links but is never the least (null only if the whole
    component has none).
    """
    prints = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = component_labels(fingerprint_edges(distinct.select("fp"), most))
    placed = distinct.join(labels, distinct["fp"] == labels["node"], "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    ids = placed.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = placed.join(ids, "label").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one_of_each(docs: DataFrame, shingle: int = 4, most: int = 4) -> DataFrame:
    """Documents whose doc_id is the least of its component; other columns are untouched.

    Rows without a doc_id stay. Of repeated rows with one doc_id a single one stays.
    """
    found = near_duplicate_components(docs, shingle, most)
    kept = (
        found.filter(F.col("doc_id") == F.col("component_id"))
        .groupBy("doc_id")
        .agg(F.count("*").alias("n"))
    )
    kept = cut_lineage(kept)
    once = docs.join(kept.filter("n = 1").select("doc_id"), "doc_id", "left_semi")
    again = docs.join(kept.filter("n > 1").select("doc_id"), "doc_id", "left_semi")
    out = once.union(again.dropDuplicates(["doc_id"]))
    return out.union(docs.filter(F.col("doc_id").isNull())).select(*own_columns(docs))

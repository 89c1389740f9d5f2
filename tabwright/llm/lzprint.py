"""Document fingerprints from the phrases of a Lempel-Ziv parse."""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record_batch, shuffle_partitions, slices
from .linecrf import SpanHasher

#: Phrases of a parse held in a dictionary; older ones move to sorted arrays.
RECENT = 1 << 20
#: Least hashes kept per document, 32 bits each.
SIGNATURE = 64
#: Ids sort null last.
LAST = (1 << 63) - 1


class PhraseParse:
    """Incremental parse into phrases, each the longest known phrase and one more byte.

    No phrase is ever forgotten. The newest ``recent`` are in a dictionary, older ones in
    sorted arrays of 16 bytes a phrase, merged so that each is over twice as long as the next.
    """

    def __init__(self, recent: int = RECENT):
        self.trie, self.older, self.recent = {}, [], recent
        self.ends, self.node, self.length, self.made = array("q"), 0, 0, 1

    def fork(self) -> PhraseParse:
        other = PhraseParse(self.recent)
        other.trie, other.older, other.ends = dict(self.trie), list(self.older), self.ends[:]
        other.node, other.length, other.made = self.node, self.length, self.made
        return other

    def _find_older(self, key: int):
        for keys, nodes in self.older:
            at = bisect_left(keys, key)
            if at < len(keys) and keys[at] == key:
                return nodes[at]
        return None

    def _set_aside(self) -> None:
        keys = np.fromiter(self.trie.keys(), np.int64, len(self.trie))
        nodes = np.fromiter(self.trie.values(), np.int64, len(self.trie))
        while self.older and len(self.older[-1][0]) <= 2 * len(keys):
            before = self.older.pop()
            keys = np.concatenate([np.frombuffer(before[0], np.int64), keys])
            nodes = np.concatenate([np.frombuffer(before[1], np.int64), nodes])
        order = np.argsort(keys)
        self.older.append((array("q", keys[order].tobytes()), array("q", nodes[order].tobytes())))
        self.trie.clear()

    def feed(self, data: bytes) -> PhraseParse:
        trie, older, node, made = self.trie, self.older, self.node, self.made
        get, found, full = trie.get, self.ends.append, made + self.recent - len(trie)
        for at, byte in enumerate(data, self.length + 1):
            key = node << 8 | byte
            node = get(key)
            if node is None:
                if older:
                    node = self._find_older(key)
                    if node is not None:
                        continue
                if made == full:
                    self._set_aside()
                    full = made + self.recent
                trie[key] = made
                made += 1
                found(at)
                node = 0
        self.node, self.length, self.made = node, self.length + len(data), made
        return self

    def signature(self, data: bytes) -> np.ndarray:
        """The least distinct hashes of the phrases of ``data``, which has been fed."""
        ends = np.array(self.ends, np.int64)
        if self.node:
            ends = np.append(ends, self.length)
        if not len(ends):
            return np.zeros(0, np.uint32)
        starts = np.concatenate(([0], ends[:-1]))
        hashes = SpanHasher(np.frombuffer(data, np.uint8)).spans(starts, ends)
        short = np.unique((hashes >> np.uint64(32)).astype(np.uint32))
        return short[:SIGNATURE]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common phrases: of the least hashes of both, those in each.

    Exact for documents of fewer distinct phrases than a signature holds; two documents
    without phrases are alike.
    """
    union = np.union1d(a, b)[:SIGNATURE]
    if not len(union):
        return 1.0
    return len(np.intersect1d(np.intersect1d(a, b, True), union, True)) / len(union)


def text_signature(text: str) -> np.ndarray:
    data = text.encode("utf-8")
    return PhraseParse().feed(data).signature(data)


def print_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


class _Held:
    """A document that waits for the one after it."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text = doc_id, text
        swap = len(text) // 4
        self.head = text[: len(text) - swap]
        data, head = text.encode("utf-8"), self.head.encode("utf-8")
        self.at_cut = PhraseParse().feed(head)
        whole = self.at_cut.fork() if swap else self.at_cut
        whole.feed(data[len(head) :])
        self.print = whole.signature(data)

    def row(self, text: str, following: np.ndarray) -> tuple:
        swap = len(self.text) // 4
        if swap:
            edited = (self.head + text[:swap]).encode("utf-8")
            self.at_cut.feed(text[:swap].encode("utf-8"))
            changed = self.at_cut.signature(edited)
        else:
            edited, changed = self.text.encode("utf-8"), self.print
        return (
            self.doc_id,
            len(self.text),
            hashlib.sha256(edited).hexdigest(),
            print_text(self.print),
            print_text(changed),
            likeness(self.print, changed),
            likeness(self.print, following),
        )


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _starts(rows: DataFrame, blocks: int) -> dict[int, list[bytes]]:
    """Where blocks begin: ids and, for an id of many rows, the texts at which it is split.

    Ids begin blocks at quantiles of their distance from the least; an id that takes several
    of them, and null ids by their share, are split at the first 200 bytes of sampled texts,
    eight for each block. The sample only decides how even the blocks are.
    """
    least, total, named = rows.agg(F.min("doc_id"), F.count("*"), F.count("doc_id")).head()
    starts, crowded = {}, {}
    if named:
        starts[least] = []
        share = max(1, round(blocks * named / total))
        shares = [i / share for i in range(1, share)]
        if shares:
            distance = F.col("doc_id").cast("decimal(20,0)") - F.lit(least).cast("decimal(20,0)")
            inner = rows.agg(F.percentile_approx(distance, shares, 100 * blocks)).head()[0]
            for x in inner:
                at = min(least + int(x), LAST)
                starts[at] = []
                crowded[at] = crowded.get(at, 0) + 1
    if named < total:
        starts[LAST] = []
        crowded[LAST] = max(1, round(blocks * (total - named) / total))
    crowded = {k: n for k, n in crowded.items() if n > 1}
    if crowded:
        heads = (
            rows.filter(F.col("place").isin(*crowded))
            .select("place", F.substring(F.col("body").cast("binary"), 1, 200).alias("head"))
            .orderBy(F.rand(0))
            .limit(8 * sum(crowded.values()))
            .collect()
        )
        for place, n in crowded.items():
            texts = sorted(bytes(r.head) for r in heads if r.place == place)
            chosen = {texts[i * len(texts) // n] for i in range(1, n)} if texts else set()
            starts[place] = sorted(chosen - {b""})
    return dict(sorted(starts.items()))


class _Blocks:
    """The block of a row by its place and, where an id is split, its text."""

    def __init__(self, starts: dict[int, list[bytes]]):
        self.places = np.array(list(starts), np.int64)
        self.heads = list(starts.values())
        sizes = np.array([1 + len(h) for h in self.heads], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.split = sizes > 1

    def of(self, place: np.ndarray, bodies) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of rows, and which rows have an id that is split; ``bodies(i)`` gives a text."""
        at = np.searchsorted(self.places, place, side="right") - 1
        block = self.first[at]
        inside = self.split[at] & (self.places[at] == place)
        past = self.split[at] & ~inside
        block[past] += np.array([len(self.heads[a]) for a in at[past]], np.int64)
        for i in np.flatnonzero(inside):
            block[i] += bisect_right(self.heads[at[i]], bodies(i))
        return block, inside


def _first_rows(rows: DataFrame, starts: dict[int, list[bytes]]) -> dict[int, tuple[int, bytes | None]]:
    """For each block that has rows, the id of its first row and, if split, the text's SHA-256."""
    crowded = [k for k, heads in starts.items() if heads]
    split = F.col("place").isin(*crowded) if crowded else F.lit(False)
    schema = pa.schema([("block", pa.int64()), ("place", pa.int64()), ("body", pa.binary())])

    def run(batches):
        blocks, found = _Blocks(starts), {}
        for batch in batches:
            texts = batch.column(1)
            place = batch.column(0).to_numpy()
            block, inside = blocks.of(place, lambda i: texts[int(i)].as_py())
            if not inside.any():
                order = np.lexsort((place, block))
                tops = order[np.flatnonzero(np.diff(block[order], prepend=-1))]
            else:
                tops = np.arange(len(place))
            for i in tops:
                own = (int(place[i]), texts[int(i)].as_py() if inside[i] else b"")
                if own < found.get(int(block[i]), (LAST + 1, b"")):
                    found[int(block[i])] = own
        if found:
            yield record_batch(schema, [list(found), *zip(*found.values())])

    narrow = rows.select("place", F.when(split, F.col("body").cast("binary")).otherwise(F.lit(b"")).alias("body"))
    least = F.min(F.struct("place", "body"))
    tops = (
        narrow.mapInArrow(run, "block long, place long, body binary")
        .groupBy("block")
        .agg(least.alias("least"))
        .select("block", "least.place", F.sha2("least.body", 256).alias("digest"))
        .collect()
    )
    return {r.block: (r.place, r.digest if r.place in crowded else None) for r in tops}


def _in_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """Rows with the block of their range; the first of a block is a guest of the one before.

    The guest of the last block is the first document of all. A few rows that tie with the
    first one may be guests too; the least of them counts. The driver holds a place and a
    checksum for each block.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("place"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"),
    )
    starts = _starts(rows, blocks)
    firsts = _first_rows(rows, starts) if starts else {}
    known = sorted(firsts)
    before = {b: known[i - 1] for i, b in enumerate(known)}
    by_place = {}
    for b, (place, digest) in firsts.items():
        by_place.setdefault(place, []).append((b, digest))
    ids = np.array(sorted(by_place), np.int64)
    schema = pa.schema(
        [("block", pa.int32()), ("guest", pa.bool_())]
        + [("doc_id", pa.int64()), ("place", pa.int64()), ("body", pa.string())]
    )

    def run(batches):
        rule = _Blocks(starts)
        for batch in batches:
            place, texts = batch.column(1).to_numpy(), batch.column(2)
            block, _ = rule.of(place, lambda i: texts[int(i)].as_py().encode())
            yield record_batch(schema, [block, np.zeros(len(block), bool), *batch.columns])
            guests, homes = [], []
            for i in np.flatnonzero(np.isin(place, ids)):
                for b, digest in by_place[int(place[i])]:
                    if b == block[i] and (
                        digest is None or hashlib.sha256(texts[int(i)].as_py().encode()).hexdigest() == digest
                    ):
                        guests.append(i)
                        homes.append(before[b])
            if guests:
                taken = batch.take(pa.array(guests))
                yield record_batch(schema, [homes, np.ones(len(homes), bool), *taken.columns])

    return rows.mapInArrow(run, "block int, guest boolean, doc_id long, place long, body string")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and two likenesses.

    The edited text has its last floor(n_chars/4) code points replaced by the first as many
    of the next document in ascending doc_id (nulls last; rows of one id by text; after the
    last the first). Each text is parsed once: the edited text goes on from the parse at the
    cut. Documents are dealt by ranges of ids, and many rows of one id (or without one) by
    ranges of their texts, so neighbours meet without a global order in one task; copies of
    one row stay together. A single document is its own next one.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64())]
        + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
        + [("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def run(batches):
        held, block, closed, same = None, None, False, None
        for part in (x for batch in batches for x in slices([batch])):
            rows = []
            columns = [part.column(i).to_pylist() for i in range(4)]
            for own, guest, doc_id, text in zip(*columns):
                if own != block:
                    held, block, closed = None, own, False
                if closed:
                    continue
                if guest:
                    rows.append(held.row(text, text_signature(text)))
                    held, closed = None, True
                    continue
                if held is not None and same is not None and text == held.text == same[0]:
                    rows.append((held.doc_id, *same[1]))  # a copy between two copies
                    held.doc_id = doc_id
                    continue
                now = _Held(doc_id, text)
                if held is not None:
                    rows.append(held.row(text, now.print))
                    same = (text, rows[-1][1:]) if text == held.text else None
                held = now
            if rows:
                yield record_batch(schema, zip(*rows))

    return (
        _in_blocks(docs, 4 * parts)
        .repartition(parts, "block")
        .sortWithinPartitions("block", "guest", "place", "body")
        .select("block", "guest", "doc_id", "body")
        .mapInArrow(run, OUT)
    )

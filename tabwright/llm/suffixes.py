"""Exact removal of long repeated byte strings with suffix arrays.

A string of ``LENGTH`` bytes is looked at only where an anchor brings it together with its
copies. The anchor of a string is the leftmost of its ``GRAM``-byte pieces with the least hash, so
equal strings have equal anchors, wherever they stand. Strings with one anchor instance form a
context, a stretch of the document. Then:

1. Each task collapses equal contexts of its documents, and the rest is shuffled by anchor. There
   the first of equal contexts is found; all others are removed entirely.
2. Contexts that share an anchor and differ (where copies begin, end or were edited) are fetched
   with their bytes and dealt into shards by anchor. Each shard builds a suffix array by
   Larsson-Sadakane refinement and common prefixes by Kasai's inheritance, which tell which strings
   are equal. An anchor with very many different contexts is spread over several shards, whose
   sorted strings are merged afterwards.
3. Each document drops the bytes its removed strings cover.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.rownum import number_rows
from tabwright.session import cut_lineage, scratch_path

from .common import own_columns, record_batch, shuffle_partitions, slices
from .linecrf import SpanHasher

LENGTH = 100
GRAM = 24
#: Bytes of contexts in one suffix array, and contexts of one anchor in one shard.
SHARD_BYTES = 1 << 20
SHARD_CONTEXTS = 20_000

SPAN = pa.schema(
    [("key", pa.int64()), ("body_key", pa.int64()), ("place", pa.int64())]
    + [("start", pa.int64()), ("stop", pa.int64())]
)
SPAN_DDL = "key long, body_key long, place long, start long, stop long"


def contexts(bodies: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(document, start, stop, anchor hash, content hash) of every context, in text order."""
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    ends = np.cumsum(sizes)
    per = np.maximum(0, sizes - length + 1)
    total = int(per.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    data = np.frombuffer(b"".join(bodies), np.uint8)
    hasher = SpanHasher(data)
    least = hasher.spans(np.arange(len(data) - gram + 1), np.arange(gram, len(data) + 1))
    grams, width = length - gram + 1, 1
    where = np.arange(len(least), dtype=np.int32)

    def narrowed(step: int):
        """Least hash and its leftmost place over two runs that start ``step`` apart."""
        left = least[:-step] <= least[step:]
        return np.minimum(least[:-step], least[step:]), np.where(left, where[:-step], where[step:])

    while 2 * width <= grams:
        least, where = narrowed(width)
        width *= 2
    if grams > width:
        least, where = narrowed(grams - width)
    doc = np.repeat(np.arange(len(bodies)), per)
    at = np.arange(total) + np.repeat(ends - sizes - (np.cumsum(per) - per), per)
    value, anchor = least[at], where[at]
    new = np.ones(total, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], total) - 1
    start, stop = at[first], at[last] + length
    offset = (ends - sizes)[doc[first]]
    return doc[first], start - offset, stop - offset, value[first], hasher.spans(start, stop)


def merged(place: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Maximal runs of spans that overlap or touch, per place."""
    if not len(place):
        return place, start, stop
    order = np.lexsort((start, place))
    place, start, stop = place[order], start[order], stop[order]
    step = int(stop.max()) + 2
    # spans of later places never reach back: shift each place into a range of its own
    ranks = np.unique(place, return_inverse=True)[1]
    reach = np.maximum.accumulate(stop + ranks * step)
    new = np.ones(len(place), bool)
    new[1:] = (start + ranks * step)[1:] > reach[:-1]
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(place)) - 1
    return place[head], start[head], reach[tail] - ranks[tail] * step


def _anchor_rows(batches):
    """Contexts to compare elsewhere, and the spans of those already repeated in this task."""
    for part in slices(batches):
        places = part.column(0).to_numpy()
        doc, start, stop, key, body = contexts(part.column(1).to_pylist())
        if not len(doc):
            continue
        place = places[doc]
        order = np.lexsort((start, place, body, key))
        same = np.zeros(len(order), bool)
        a, b = order[1:], order[:-1]
        same[1:] = (key[a] == key[b]) & (body[a] == body[b])
        again, once = order[same], order[~same]
        if len(again):
            p, s, e = merged(place[again], start[again], stop[again])
            none = pa.nulls(len(p), pa.int64())
            yield record_batch(SPAN, [p, none, p, s, e])
        yield record_batch(
            SPAN,
            [key.view(np.int64)[once], body.view(np.int64)[once], place[once], start[once], stop[once]],
        )


def _first_of_equal(batches):
    """Rows sorted by key, body_key, place, start: who repeats whom.

    Gives spans (key null) for all but the first row of equal contexts, and the first rows
    themselves (body_key null) where a key has several different contexts. Only the last row
    is carried from batch to batch, so a key may have any number of rows.
    """
    last, pending = None, None  # last context seen; a first row that waits for the next key
    shown = False  # whether the pending row's key already has another context
    for batch in batches:
        known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        columns = [
            batch.column(i).fill_null(0).to_numpy() if i == 1 else batch.column(i).to_numpy()
            for i in range(5)
        ]
        local = ~known
        if local.any():
            p, s, e = (c[local] for c in columns[2:])
            none = pa.nulls(len(p), pa.int64())
            yield record_batch(SPAN, [none, none, p, s, e])
        key, body, place, start, stop = (c[known] for c in columns)
        if not len(key):
            continue
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (body[1:] != body[:-1])
        new[0] = last != (key[0], body[0])
        if not new.all():
            p, s, e = merged(place[~new], start[~new], stop[~new])
            none = pa.nulls(len(p), pa.int64())
            yield record_batch(SPAN, [none, none, p, s, e])
        last = (key[-1], body[-1])
        if not new.any():
            continue
        rows = [c[new] for c in (key, place, start, stop)]
        if pending is not None:
            rows = [np.append(p, r) for p, r in zip(pending, rows)]
        k = rows[0]
        several = np.zeros(len(k), bool)
        several[0] = pending is not None and shown
        several[1:] |= k[1:] == k[:-1]
        several[:-1] |= k[1:] == k[:-1]
        shown = bool(several[-1])
        pending = [r[-1:] for r in rows]
        out = np.flatnonzero(several[:-1])
        if len(out):
            k, p, s, e = (r[out] for r in rows)
            yield record_batch(SPAN, [k, pa.nulls(len(k), pa.int64()), p, s, e])
    if pending is not None and shown:
        k, p, s, e = pending
        yield record_batch(SPAN, [k, pa.nulls(1, pa.int64()), p, s, e])


def suffix_order(data: np.ndarray, depth: int = LENGTH):
    """Suffixes of ``data`` sorted by their first ``depth`` bytes, by Larsson-Sadakane refinement.

    Ranks start from 8 bytes; each step sorts only the groups that are still tied, by the
    rank of the suffix ``h`` bytes further on, which doubles the sorted depth.
    """
    n = len(data)
    padded = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64)
    first = np.zeros(n, np.uint64)
    for k in range(8):
        first = first << np.uint64(8) | padded[k : n + k]
    order = np.argsort(first, kind="stable")
    rank = np.zeros(n + depth, np.int64)  # beyond the end: below every suffix
    new = np.ones(n, bool)
    new[1:] = first[order[1:]] != first[order[:-1]]
    tied = _assign(order, np.arange(n), new, rank)
    sorted_to = 8
    while sorted_to < depth and len(tied):
        step = min(sorted_to, depth - sorted_to)
        inside = order[tied]
        own, further = rank[inside], rank[inside + step]
        resort = np.lexsort((further, own))
        order[tied] = inside[resort]
        own, further = own[resort], further[resort]
        new = np.ones(len(own), bool)
        new[1:] = (own[1:] != own[:-1]) | (further[1:] != further[:-1])
        tied = _assign(order, tied, new, rank)
        sorted_to += step
    return order


def _assign(order, slots, new, rank):
    """Number groups by their first slot; the slots of groups of several suffixes."""
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(slots)))
    rank[order[slots]] = np.repeat(slots[heads], sizes) + 1
    return slots[np.repeat(sizes > 1, sizes)]


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Common bytes of each suffix in ``order`` with the one before it, up to about ``most``.

    Kasai's inheritance, for all positions at once: where the suffix after i follows, in the
    order, the suffix after i's predecessor, it shares one byte less than i does. Only the
    positions that inherit nothing are compared, eight bytes at a time.
    """
    n = len(data)
    before = np.full(n + 1, -2, np.int64)
    before[order[1:]] = order[:-1]
    if len(order):
        before[order[0]] = -2
    at = np.sort(order)
    linked = before[at] >= 0
    inherits = np.zeros(len(at), bool)
    inherits[1:] = (at[1:] == at[:-1] + 1) & linked[1:] & (before[at[1:]] == before[at[:-1]] + 1)
    words = np.append(data, np.zeros(len(data) + most + 16, np.uint8))
    wide = np.lib.stride_tricks.sliding_window_view(words, 8)
    out = np.zeros(n, np.int64)
    while True:
        heads = np.flatnonzero(~inherits)
        reach = np.diff(np.append(heads, len(at)))
        run = np.repeat(np.arange(len(heads)), reach)
        found, need = np.zeros(len(heads), np.int64), most + reach
        active = np.flatnonzero(linked[heads])
        while len(active):
            i = at[heads[active]] + found[active]
            j = before[at[heads[active]]] + found[active]
            same = wide[i] == wide[j]
            equal = np.where(same.all(axis=1), 8, np.argmin(same, axis=1))
            # padding is not text
            equal = np.minimum(equal, np.maximum(0, n - np.maximum(i, j)))
            found[active] += equal
            active = active[(equal == 8) & (found[active] < need[active])]
        own = found[run] - (np.arange(len(at)) - heads[run])
        stale = inherits & (own < 0)  # nothing is passed on past a difference
        if not stale.any():
            break
        inherits[_spaced(stale, run)] = False
    out[at] = np.maximum(0, own)
    return out[order]


def _spaced(stale: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The first stale position of each run."""
    places = np.flatnonzero(stale)
    return places[np.unique(run[places], return_index=True)[1]]


def equal_strings(bodies: list[bytes], length: int = LENGTH):
    """(body, offset, class) of every string of ``length`` bytes that occurs again in ``bodies``."""
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    data = np.frombuffer(b"".join(bodies), np.uint8)
    offset = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(bodies)), sizes)
    left = np.repeat(offset + sizes, sizes) - np.arange(len(data))
    order = suffix_order(data, length)
    order = order[left[order] >= length]
    common = common_prefixes(data, order, length)
    new = common < length
    new[:1] = True
    number = np.cumsum(new) - 1
    again = np.bincount(number)[number] > 1 if len(number) else new
    at = order[again]
    return owner[at], at - offset[owner[at]], number[again]


def _shard(rows, crowded: bool):
    """Removed spans of one shard's contexts; for a spread anchor also its own first strings."""
    key, place, start, bodies = rows
    body, offset, number = equal_strings(bodies)
    where, begin = place[body], start[body] + offset
    order = np.lexsort((begin, where, number))
    first = np.ones(len(order), bool)
    first[1:] = number[order][1:] != number[order][:-1]
    again = order[~first]
    p, s, e = merged(where[again], begin[again], begin[again] + LENGTH)
    none = pa.nulls(len(p), pa.int64())
    out = [record_batch(SPAN, [none, none, p, s, e])]
    if crowded:
        doc, at = _all_strings(bodies)
        gone = set(zip(body[again].tolist(), offset[again].tolist()))
        kept = [i for i, x in enumerate(zip(doc.tolist(), at.tolist())) if x not in gone]
        digests = np.array(
            [
                np.frombuffer(
                    hashlib.blake2b(bodies[doc[i]][at[i] : at[i] + LENGTH], digest_size=16).digest(),
                    np.int64,
                )
                for i in kept
            ],
            np.int64,
        ).reshape(-1, 2)
        doc, at = doc[kept], at[kept]
        begin = start[doc] + at
        out.append(
            record_batch(SPAN, [digests[:, 0], digests[:, 1], place[doc], begin, begin + LENGTH])
        )
    return out


def _all_strings(bodies):
    counts = [max(0, len(b) - LENGTH + 1) for b in bodies]
    doc = np.repeat(np.arange(len(bodies)), counts)
    at = np.concatenate([np.arange(c) for c in counts]) if counts else np.zeros(0, int)
    return doc, at


def _in_shards(batches):
    """Rows (cell, crowded, key, place, start, body) sorted by cell: whole cells, several a shard."""
    held, size, cell, crowded = [], 0, None, False

    def flush():
        columns = list(zip(*held))
        return _shard(
            (columns[0], *(np.array(c, np.int64) for c in columns[1:3]), list(columns[3])), crowded
        )

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if row[0] != cell:
                if held and (size > SHARD_BYTES or row[1] or crowded):
                    yield from flush()
                    held, size = [], 0
                cell, crowded = row[0], row[1]
            held.append(row[2:])
            size += len(row[5])
    if held:
        yield from flush()


def _placed(docs: DataFrame) -> DataFrame:
    """(place, body, rest): an order of the documents by doc_id without ties.

    ``place`` is the doc_id itself while ids are unique and none is null. Otherwise the
    documents are sorted by id (nulls last), then text, and numbered into a table in the
    shared folder.
    """
    rows = docs.select(
        docs["doc_id"].cast("long").alias("place"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("body"),
        F.struct(*own_columns(docs, "text")).alias("rest"),
    )
    ids = rows.groupBy("place").agg(F.count("*").alias("n"))
    if ids.filter("place is null or n > 1").head(1):
        path = scratch_path(docs.sparkSession, "numbered")
        keyed = rows.withColumn("unknown", F.col("place").isNull()).withColumnRenamed("place", "id")
        number_rows(keyed, "place", order_by=("unknown", "id", "body")).write.parquet(path)
        rows = docs.sparkSession.read.parquet(path)
    return rows.select(F.col("place").cast("long").alias("place"), "body", "rest")


def removed_spans(rows: DataFrame, dealt: DataFrame) -> DataFrame:
    """(place, start, stop) of removed bytes; ``dealt`` is ``rows`` partitioned by place."""
    parts = shuffle_partitions(rows.sparkSession)
    order = ("key", "body_key", "place", "start")
    found = cut_lineage(
        rows.select("place", "body")
        .mapInArrow(_anchor_rows, SPAN_DDL)
        .repartition(parts, "key")
        .sortWithinPartitions(*order)
        .mapInArrow(_first_of_equal, SPAN_DDL)
    )
    spans = found.filter("key is null").select("place", "start", "stop")
    wanted = found.filter("key is not null").select("key", "place", "start", "stop")
    crowded = cut_lineage(
        wanted.groupBy("key")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > SHARD_CONTEXTS)
        .select(F.col("key").alias("hot"), F.ceil(F.col("n") / SHARD_CONTEXTS).alias("shards"))
    )
    lists = wanted.groupBy("place").agg(
        F.collect_list(F.struct("key", "start", "stop")).alias("wanted")
    )
    pieces = (
        dealt.select("place", "body")
        .join(lists, "place")
        .mapInArrow(_cut_contexts, "key long, place long, start long, body binary")
    )
    hot = bool(crowded.head(1))
    if hot:
        # at most one key per SHARD_CONTEXTS contexts; broadcast below a checked count
        few = crowded.count() <= 100_000
        pieces = pieces.join(
            F.broadcast(crowded) if few else crowded, F.col("key") == F.col("hot"), "left"
        ).withColumn(
            "cell",
            F.when(F.col("hot").isNull(), F.col("key")).otherwise(
                F.xxhash64("key", F.pmod(F.xxhash64("place", "start"), F.col("shards")))
            ),
        )
    else:
        pieces = pieces.withColumn("cell", F.col("key")).withColumn("hot", F.lit(None))
    shards = (
        pieces.select("cell", F.col("hot").isNotNull().alias("crowded"), "key", "place", "start", "body")
        .repartition(parts, "cell")
        .sortWithinPartitions("cell")
        .mapInArrow(_in_shards, SPAN_DDL)
    )
    if hot:
        shards = cut_lineage(shards)
        across = (
            shards.filter("key is not null")
            .repartition(parts, "key")
            .sortWithinPartitions(*order)
            .mapInArrow(_first_of_equal, SPAN_DDL)
            .filter("key is null")
        )
        shards = shards.filter("key is null").union(across)
    return spans.union(shards.select("place", "start", "stop"))


def _cut_contexts(batches):
    schema = pa.schema(
        [("key", pa.int64()), ("place", pa.int64()), ("start", pa.int64()), ("body", pa.binary())]
    )
    for part in slices(batches):
        rows = [
            (w["key"], place, w["start"], body[w["start"] : w["stop"]])
            for place, body, wanted in zip(*(part.column(i).to_pylist() for i in range(3)))
            for w in wanted
        ]
        yield record_batch(schema, zip(*rows))


def _with_spans(docs: DataFrame) -> DataFrame:
    """(place, rest, body, spans): every document with its removed spans, null if none."""
    rows = _placed(docs)
    dealt = rows.repartition(shuffle_partitions(docs.sparkSession), "place")
    spans = removed_spans(rows, dealt)
    lists = spans.groupBy("place").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return dealt.join(lists, "place", "left").select("place", "rest", "body", "spans")


def _cut(body: bytes, spans):
    """(remaining bytes, removed bytes, maximal removed runs, first and end of kept pieces)."""
    if not spans:
        return body, 0, 0
    start = np.array([s["start"] for s in spans], np.int64)
    stop = np.array([s["stop"] for s in spans], np.int64)
    _, start, stop = merged(np.zeros(len(start), np.int64), start, stop)
    edges = [0, *np.stack([start, stop], axis=1).ravel().tolist(), len(body)]
    kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return kept, len(body) - len(kept), len(start)


def removal_report(docs: DataFrame) -> DataFrame:
    """One row per document: its bytes, what was removed, and the checksum of what is left.

    A byte goes if it lies in a string of 100 bytes that also starts earlier: in a document
    of smaller doc_id, or earlier in its own. Null texts are empty. Documents without
    doc_id come last; repeated rows of an id count as different documents in text order.
    """
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")]
        + [("kept_sha256", pa.string())]
    )

    def run(batches):
        for part in slices(batches):
            rows = []
            for doc_id, body, spans in zip(*(part.column(i).to_pylist() for i in range(3))):
                kept, removed, runs = _cut(body, spans)
                rows.append((doc_id, len(body), removed, runs, hashlib.sha256(kept).hexdigest()))
            yield record_batch(schema, zip(*rows))

    return (
        _with_spans(docs.select("doc_id", "text"))
        .select(F.col("rest.doc_id").cast("long").alias("doc_id"), "body", "spans")
        .mapInArrow(run, ddl)
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents without their repeated strings; ``n_chars``, if there, follows the text.

    A character that loses some of its bytes is dropped. Every document stays, with an
    empty text if nothing is left; null texts become empty.
    """
    cut_type = T.StructType([T.StructField("text", T.StringType())])

    def run(batches):
        for part in slices(batches):
            texts = [
                _cut(body, spans)[0].decode("utf-8", errors="ignore")
                for body, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["rest", "text"])

    rows = _with_spans(docs).select("rest", "body", "spans")
    out = rows.mapInArrow(run, T.StructType([rows.schema["rest"], *cut_type]))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars":
            columns.append(F.length("text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"rest.`{c}`").alias(c))
    return out.select(*columns)

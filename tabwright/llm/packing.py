"""Best-fit packing of documents into fixed-length token sequences."""

from __future__ import annotations

import math
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_bytes, kept_by_worker, record_batch, slices
from .encode import WordEncoder, tokenizer_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


def token_pieces(docs: DataFrame, limit: int = 2048, path: str | None = None) -> DataFrame:
    """Cut each document's ids, with the closing id 0, into pieces of ``limit`` ids at most."""
    path = path or tokenizer_path()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32())]
        + [(c, pa.int64()) for c in ("start", "length", "ids_crc32")]
    )

    def run(batches):
        # the words that earlier tasks of this worker have met are known
        encoder = kept_by_worker(("WordEncoder", path), lambda: WordEncoder(path))
        for part in slices(batches, 2 << 20):
            rows = []
            encoded = encoder.encode(part.column(1).to_pylist())
            for doc_id, ids in zip(part.column(0).to_pylist(), encoded):
                ids += b"\0\0\0\0"
                for at in range(0, len(ids), 4 * limit):
                    body = ids[at : at + 4 * limit]
                    rows.append(
                        (doc_id, at // (4 * limit), at // 4, len(body) // 4, zlib.crc32(body))
                    )
            yield record_batch(schema, zip(*rows))

    return id_and_bytes(docs).mapInArrow(run, PIECES)


class OpenBins:
    """A fixed number of open bins in a bitset keyed by free space.

    Bit ``f`` is set while some open bin has ``f`` ids free. The best fit for a piece is
    the lowest set bit at or above its length; a new bin beyond ``most`` open ones closes
    the fullest, which is the lowest set bit of all.
    """

    def __init__(self, limit: int, most: int):
        self.limit, self.most = limit, most
        self.bits, self.open, self.made = 0, 0, 0
        self.stacks: list[list[int]] = [[] for _ in range(limit + 1)]

    def _take(self, free: int) -> int:
        number = self.stacks[free].pop()
        if not self.stacks[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            number, free = self.made, self.limit
            self.made += 1
        left = free - length
        if left:
            self.stacks[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.limit - free


def pack(
    pieces: DataFrame, groups: int, limit: int = 2048, open_bins: int = 16_384
) -> DataFrame:
    """Place pieces in sequences, each of ``groups`` parts by itself, longest pieces first.

    A part is dealt by a hash of document and piece, so a hot source spreads over all parts,
    and a part needs memory for its open bins alone. Sequence numbers carry the part in
    their upper bits. Equal pieces are placed one by one; an empty table has no rows.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32())]
        + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "sequence_id", "offset")]
    )

    def run(batches):
        part, bins = None, None
        for batch in batches:
            columns = batch.to_pydict()
            numbers, offsets = [], []
            for own, length in zip(columns["part"], columns["length"]):
                if own != part:
                    part, bins = own, OpenBins(limit, open_bins)
                number, offset = bins.put(length)
                numbers.append(part << 40 | number)
                offsets.append(offset)
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield record_batch(schema, [*kept, numbers, offsets])

    dealt = pieces.withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
    )
    return (
        dealt.repartition(groups, "part")
        .sortWithinPartitions("part", F.desc("length"), "doc_id", "piece", "ids_crc32")
        .mapInArrow(run, PLACED)
    )


def pack_documents(
    docs: DataFrame,
    limit: int = 2048,
    path: str | None = None,
    group_documents: int = 50_000,
    open_bins: int = 16_384,
    group_bytes: int = 512 << 20,
) -> DataFrame:
    """One row per piece: where a document's ids lie in which sequence.

    Null and empty texts are the closing id alone. Only documents longer than ``limit`` are
    cut. The number of parts that are packed apart follows the number of documents
    (``group_documents``) or, where that gives more, the bytes of the texts
    (``group_bytes``); each part leaves its last bins partly empty.
    """
    documents, size = docs.agg(
        F.count("*"), F.sum(F.octet_length(F.col("text").cast("string")))
    ).first()
    groups = max(1, math.ceil(documents / group_documents), math.ceil((size or 0) / group_bytes))
    return pack(token_pieces(docs, limit, path), groups, limit, open_bins)

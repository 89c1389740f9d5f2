"""Hierarchical packing of documents into sequences of several lengths, without padding.

Windows have the lengths of the tiers, powers of two up to the longest context. Whole windows
are cut from long documents; what is left of a document is routed to the shortest tier it fits
in. From the longest tier down, a window opens with the longest piece of its tier and its gap
is filled with the best-fitting pieces of shorter tiers, the last of them cut to size. Filled
windows are dealt to step groups of equal tokens and a like mix of tiers.
"""

from __future__ import annotations

import base64
import heapq
import os
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, kept_by_worker, record_batch
from .encode import tokenizer_path

PLACED = (
    "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long"
)
#: A long text is encoded in parts of about so many characters.
PART = 1 << 20


@dataclass(frozen=True)
class TierSpec:
    """``tiers``: window lengths, rising powers of two. ``end_id`` closes every document.
    ``block_tokens`` are buffered before a block is packed; ``group_tokens`` make a step group."""

    tiers: tuple = (256, 512, 1024, 2048)
    end_id: int = 1
    block_tokens: int = 1 << 20
    group_tokens: int = 1 << 16

    def __post_init__(self):
        if list(self.tiers) != sorted(set(self.tiers)) or any(t < 1 or t & (t - 1) for t in self.tiers):
            raise ValueError("tiers are rising powers of two")


class ByteEncoder:
    """Ids of whole texts under the public byte-level vocabulary, as its own tokenizer gives them.

    The rank file holds the same vocabulary and merges; a text that spells the special token
    goes through the tokenizer itself. Texts are cut before white space that follows other
    characters, where no merge reaches across, so a long text needs little memory.
    """

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.tokenizer = path, None
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as ranks:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks)}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})

    def _whole(self, text: str) -> list[int]:
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> np.ndarray:
        if "<|endoftext|>" in text:
            return np.array(self._whole(text), "<u4")
        parts = [np.array(self.fast.encode_ordinary(p), "<u4") for p in text_parts(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def text_parts(text: str, size: int = PART):
    """Cut a text before blanks that follow a character which is no white space."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


@dataclass
class Piece:
    """``length`` ids of a document from ``start`` on; ``ids`` are those from ``held`` on."""

    doc: tuple
    ids: np.ndarray
    held: int
    start: int
    length: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.ids, self.held, self.start, length),
            Piece(self.doc, self.ids, self.held, self.start + length, self.length - length),
        )

    def body(self) -> bytes:
        first = self.start - self.held
        return self.ids[first : first + self.length].tobytes()


@dataclass
class Pending:
    """Pieces that wait for a window, in stacks by length; a bitset tells which have any."""

    limit: int
    bits: int = 0
    stacks: dict = field(default_factory=dict)

    def add(self, piece: Piece) -> None:
        self.stacks.setdefault(piece.length, []).append(piece)
        self.bits |= 1 << piece.length

    def take(self, length: int) -> Piece:
        stack = self.stacks[length]
        piece = stack.pop()
        if not stack:
            self.bits &= ~(1 << length)
        return piece

    def longest(self, most: int) -> int:
        """The greatest waiting length up to ``most``, 0 if there is none."""
        return max(0, (self.bits & ((1 << (most + 1)) - 1)).bit_length() - 1)

    def shortest(self, least: int) -> int:
        """The smallest waiting length from ``least`` on, 0 if there is none."""
        above = self.bits >> least
        return least + (above & -above).bit_length() - 1 if above else 0


class TierPacker:
    """Packs one stream of documents; holds a block of it and the windows of that block."""

    def __init__(self, spec: TierSpec):
        self.spec, self.limit = spec, spec.tiers[-1]
        self.waiting = Pending(self.limit)
        self.windows: list[list[Piece]] = []
        self.tokens = 0

    def add(self, doc: tuple, ids: np.ndarray) -> None:
        """Whole windows of a document, and what is left as a waiting piece."""
        whole = len(ids) - len(ids) % self.limit
        for start in range(0, whole, self.limit):
            self.windows.append([Piece(doc, ids, 0, start, self.limit)])
        if len(ids) > whole:
            # a copy, so that the rest does not hold all ids of a long document
            self.waiting.add(Piece(doc, ids[whole:].copy(), whole, whole, len(ids) - whole))
        self.tokens += len(ids)

    def fill(self, tier: int, first: Piece) -> list[Piece]:
        """A window of a tier: best fits from what waits, the last piece cut to the gap.

        Less than a full window comes back only when nothing waits any more.
        """
        window, gap = [first], tier - first.length
        while gap and self.waiting.bits:
            if fit := self.waiting.longest(gap):
                piece = self.waiting.take(fit)
            else:
                piece, rest = self.waiting.take(self.waiting.shortest(gap)).cut(gap)
                self.waiting.add(rest)
            window.append(piece)
            gap -= piece.length
        return window

    def pack(self, last: bool = False) -> list[list[Piece]]:
        """Full windows of all tiers. The rest waits for the next block; the last block cuts it
        into windows that are powers of two."""
        for tier in reversed(self.spec.tiers):
            shorter = tier // 2 if tier > self.spec.tiers[0] else 0
            while (length := self.waiting.longest(tier)) > shorter:
                window = self.fill(tier, self.waiting.take(length))
                if sum(p.length for p in window) < tier:
                    return self.closed(window, last)
                self.windows.append(window)
        return self.closed([], last)

    def closed(self, rest: list[Piece], last: bool) -> list[list[Piece]]:
        """The windows of the block; ``rest`` is all that is left of it."""
        full, self.windows, self.tokens = self.windows, [], 0
        if last:
            return full + in_powers(rest)
        for piece in rest:
            self.waiting.add(piece)
            self.tokens += piece.length
        return full


def in_powers(pieces: list[Piece]) -> list[list[Piece]]:
    """Windows whose lengths are the binary digits of the pieces' total, greatest first."""
    left = sum(p.length for p in pieces)
    queue, out = pieces[::-1], []
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        window = []
        while size:
            piece = queue.pop()
            if piece.length > size:
                piece, rest = piece.cut(size)
                queue.append(rest)
            window.append(piece)
            size -= piece.length
        out.append(window)
    return out


def step_groups(lengths: list[int], group_tokens: int) -> list[int]:
    """A group for every window: longest first, each to the group with the fewest tokens.

    Groups differ by one window at most, and each gets its share of every length.
    """
    groups = max(1, round(sum(lengths) / group_tokens))
    heap = [(0, g) for g in range(groups)]
    out = [0] * len(lengths)
    for place in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        filled, group = heapq.heappop(heap)
        out[place] = group
        heapq.heappush(heap, (filled + lengths[place], group))
    return out


def pack_tiers(docs: DataFrame, spec: TierSpec = TierSpec(), path: str | None = None) -> DataFrame:
    """One row per piece: its ids, its sequence, its place there, the tier and the step group.

    A null text is empty: the closing id alone. Every task packs the documents it reads, block
    by block, so nothing is shuffled and memory holds one block; a task's last windows are the
    powers of two that make up its rest. Numbers of sequences and groups carry the task's
    partition in their upper bits, so a task that runs again gives the same numbers. Repeated
    rows are packed one by one; an empty table has no rows.
    """
    path = path or tokenizer_path("byte_bpe_50k.json")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())]
        + [(c, pa.int64()) for c in ("doc_tokens", "sequence_id", "offset")]
        + [("tier", pa.int32()), ("step_group", pa.int64())]
    )

    def run(batches):
        encoder = kept_by_worker(("ByteEncoder", path), lambda: ByteEncoder(path))
        packer = TierPacker(spec)
        base = TaskContext.get().partitionId() << 40
        numbers = {"sequence": base, "group": base}

        def rows(windows):
            totals = [sum(p.length for p in w) for w in windows]
            groups = step_groups(totals, spec.group_tokens)
            out = []
            for window, total, group in zip(windows, totals, groups):
                offset = 0
                for p in window:
                    doc_id, size = p.doc
                    out.append(
                        (doc_id, p.start, p.body(), size, numbers["sequence"], offset, total, numbers["group"] + group)
                    )
                    offset += p.length
                numbers["sequence"] += 1
            numbers["group"] += max(groups, default=-1) + 1
            for at in range(0, len(out), 4096):
                yield record_batch(schema, zip(*out[at : at + 4096]))

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = np.append(encoder.encode(text.as_py()), np.uint32(spec.end_id)).astype("<u4")
                packer.add((doc_id.as_py(), len(ids)), ids)
                if packer.tokens >= spec.block_tokens:
                    yield from rows(packer.pack())
        yield from rows(packer.pack(last=True))

    return id_and_text(docs).mapInArrow(run, PLACED)


def placement_report(docs: DataFrame, spec: TierSpec = TierSpec(), path: str | None = None) -> DataFrame:
    """Pieces with length and CRC-32 of their ids instead of the ids."""
    return pack_tiers(docs, spec, path).select(
        "doc_id",
        "start",
        F.expr("octet_length(ids) div 4").cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "tier",
        "step_group",
    )

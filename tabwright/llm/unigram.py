"""Unigram encoding of text over a public piece vocabulary, and its decoding."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_bytes, record_batch, slices
from .encode import CACHED_WORDS

MARK = "▁".encode()
#: How much worse than the worst piece a character without piece is.
UNKNOWN_PENALTY = 10.0


def build_double_array(keys: list[bytes]):
    """(base, check, value) of a double-array trie over sorted distinct byte strings.

    The child of state s by byte c is base[s] + c, if check[] of that state is s. ``value``
    holds a key's number at the state where it ends, else -1.
    """
    size = 8 * sum(map(len, keys)) + 1024
    base, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    value = np.full(size, -1, np.int64)
    check[0] = 0
    single_from, wide_from = 257, 257  # every byte value lies below

    def place(codes: np.ndarray, start: int) -> int:
        """The first offset at or after ``start`` at which all of ``codes`` are free."""
        if len(codes) == 1:
            while check[start] >= 0:
                start += 1
            return start - int(codes[0])
        while True:
            block = start + np.flatnonzero(check[start : start + 128] < 0) - codes[0]
            fits = (check[block[:, None] + codes] < 0).all(axis=1)
            if fits.any():
                return int(block[np.argmax(fits)])
            start += 128

    level = [(0, 0, len(keys), 0)]  # state, keys from, keys to, depth
    while level:
        following = []
        for state, low, high, depth in level:
            if low < high and len(keys[low]) == depth:
                value[state] = low
                low += 1
            if low == high:
                continue
            heads = [low] + [
                i for i in range(low + 1, high) if keys[i][depth] != keys[i - 1][depth]
            ]
            codes = np.array([keys[i][depth] for i in heads])
            if len(codes) == 1:
                at = place(codes, single_from)
                single_from = at + int(codes[0])
            else:
                at = place(codes, wide_from)
                wide_from = max(wide_from, at + int(codes[0]) - 64)
            base[state] = at
            check[at + codes] = state
            ends = [*heads[1:], high]
            following += [
                (at + int(c), a, b, depth + 1) for c, a, b in zip(codes, heads, ends)
            ]
        level = following
    used = int(np.flatnonzero(check >= 0)[-1]) + 257
    return base[:used], check[:used], value[:used]


@dataclass(frozen=True)
class PieceTable:
    """Pieces with their log scores as a double-array trie, spaces standing for the marker."""

    base: list[int]
    check: list[int]
    value: list[int]
    ids: list[int]
    scores: list[float]
    unknown: float
    byte_ids: list[int]
    surface: list[bytes]

    @classmethod
    def load(cls, path: str) -> PieceTable:
        """Pieces, scores and byte pieces of a model file; nothing is trained."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        normal = {}
        surface = [b""] * count
        byte_ids = [0] * 256
        for i in range(count):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                surface[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                surface[i] = piece.encode().replace(MARK, b" ")
                normal[surface[i]] = i
        if any(re.search(rb"[^ ] |\n", key) for key in normal):
            raise ValueError("a piece crosses white space, so words cannot be encoded apart")
        keys = sorted(normal)
        ids = [normal[k] for k in keys]
        scores = [model.get_score(i) for i in ids]
        arrays = [x.tolist() for x in build_double_array(keys)]
        return cls(*arrays, ids, scores, min(scores) - UNKNOWN_PENALTY, byte_ids, surface)


class UnigramCoder:
    """Best segmentation by summed log scores, each distinct word once per cache."""

    #: A word with the blanks before it, trailing blanks, or a line break; pieces never cross these.
    PARTS = re.compile(rb" *[^ \n]+| +|\n")

    def __init__(self, table: PieceTable):
        self.table = table
        self.known: dict[bytes, tuple[bytes, float, int]] = {}

    def viterbi(self, word: bytes) -> tuple[bytes, float, int]:
        """(ids as 32-bit values, score, byte pieces) of one word.

        Of equal scores the segmentation whose last piece starts first wins. A character
        without a piece of its own costs ``unknown`` and becomes its bytes.
        """
        t = self.table
        base, check, value, scores = t.base, t.check, t.value, t.scores
        n = len(word)
        best: list[float | None] = [0.0] + [None] * n
        back = [(0, -1)] * (n + 1)
        for i in range(n):
            here = best[i]
            if here is None:
                continue
            lead = word[i]
            width = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            single, state, j = False, 0, i
            while j < n:
                step = base[state] + word[j]
                if check[step] != state:
                    break
                state = step
                j += 1
                key = value[state]
                if key >= 0:
                    score = here + scores[key]
                    if best[j] is None or score > best[j]:
                        best[j] = score
                        back[j] = (i, key)
                    if j - i == width:
                        single = True
            if not single:
                j = min(n, i + width)
                score = here + t.unknown
                if best[j] is None or score > best[j]:
                    best[j] = score
                    back[j] = (i, -1)
        ids: list[int] = []
        bytes_used, at = 0, n
        while at:
            start, key = back[at]
            if key < 0:
                ids += [t.byte_ids[b] for b in reversed(word[start:at])]
                bytes_used += at - start
            else:
                ids.append(t.ids[key])
            at = start
        return np.array(ids[::-1], "<u4").tobytes(), best[n], bytes_used

    def encode(self, body: bytes) -> tuple[bytes, float, int]:
        """Ids, score and byte pieces of a text, which gets one marker in front.

        Blanks and literal markers are the same to the vocabulary. An empty text has no ids.
        """
        if not body:
            return b"", 0.0, 0
        known = self.known
        words = self.PARTS.findall(b" " + body.replace(MARK, b" "))
        if len(known) > CACHED_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = self.viterbi(word)
        found = list(map(known.__getitem__, words))
        ids, scores, spelled = zip(*found)
        return b"".join(ids), sum(scores), sum(spelled)

    def decode(self, ids: bytes) -> str:
        """Text of ids: markers become blanks, byte pieces UTF-8; the first blank is dropped."""
        surface = self.table.surface
        data = b"".join(map(surface.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data[data[:1] == b" " :].decode("utf-8", errors="replace")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


OUT = (
    "doc_id long, n_pieces long, n_byte_pieces long, score double, ids_crc32 long, "
    "decoded_crc32 long, round_trip boolean"
)


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per document: size, score and checksums of its ids, and of their decoding.

    ``with_ids`` adds the ids themselves (array<int>). ``round_trip`` is false only where a
    text spells the marker character, which decodes as a blank. Null and empty texts have no
    pieces. Words are encoded apart, so a text of any length needs memory in proportion to
    itself; the trie is built once and broadcast, its size being that of the vocabulary.
    """
    loaded = PieceTable.load(path or piece_model_path())
    # plain lists: a broadcast object of a class would need this package in the workers
    parts = {f.name: getattr(loaded, f.name) for f in fields(PieceTable)}
    table = docs.sparkSession.sparkContext.broadcast(parts)
    columns = [("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("n_byte_pieces", pa.int64())]
    columns += [("score", pa.float64()), ("ids_crc32", pa.int64()), ("decoded_crc32", pa.int64())]
    columns += [("round_trip", pa.bool_())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(columns)

    def run(batches):
        coder = UnigramCoder(PieceTable(**table.value))
        for part in slices(batches):
            rows = []
            for doc_id, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids, score, spelled = coder.encode(body)
                decoded = coder.decode(ids).encode("utf-8")
                row = (doc_id, len(ids) // 4, spelled, score, zlib.crc32(ids))
                row += (zlib.crc32(decoded), decoded == body)
                rows.append((*row, np.frombuffer(ids, "<i4")) if with_ids else row)
            yield record_batch(schema, zip(*rows))

    return id_and_bytes(docs).mapInArrow(run, OUT + ", ids array<int>" * with_ids)

"""Hierarchical Pitman-Yor language model of words, trained and applied as Spark jobs.

Every word follows a context, the word before it; each context is a Chinese restaurant, and all
of them share one parent restaurant over words, whose base is uniform over the training words
and one share for all unseen ones. A context is known by its hash, cut to so many bits beyond
the number of tokens (``spare_bits``) that few words share one; their number is not limited.

1. Tasks turn documents into shards: token numbers and the words behind them.
2. Shards send each bucket of words their (word, context) pairs with counts, so a frequent pair
   costs a shard one entry. Pairs of a hot word are dealt to several buckets by context.
3. A bucket keeps the seating of its pairs and words from pass to pass and moves customers one
   by one (Gibbs). After a pass the tables of every context are added up at its home, a group
   of contexts, and go back to the buckets that hold the context.
4. Every sampled seating has totals of exactly that seating, so the predictive probabilities of
   a context sum to one. Buckets answer each shard with their average over the samples, and
   shards sum them over their documents.

Within a pass a bucket sees its own moves at once and those of other buckets at its end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import cut_lineage, scratch_path

from .common import cut_partitioned, id_and_bytes, mix64, record_batch, shuffle_partitions, slices
from .linecrf import SpanHasher

#: What ends a text, and what its first word follows; no word has these hashes but by chance.
END, START = np.uint64(0xE7D00000000000E7), np.uint64(0x57A2700000000057)
#: Only for the first seating: dishes with more customers grow by steps from here on.
ONE_BY_ONE = 256


@dataclass(frozen=True)
class ModelSpec:
    """``strength``: theta of every restaurant. ``passes``: passes over all buckets.

    ``rounds``: rounds of moves in a pass; ``moves``: customers of a dish that leave and sit
    down again in a round. ``samples``: seatings of the last pass, one a round, whose predictive
    probabilities are averaged. ``shard_tokens``, ``bucket_tokens``: tokens of a shard, of a
    bucket. ``spare_bits``: one word in 2**spare_bits or fewer shares its context.
    """

    strength: float = 1.0
    passes: int = 2
    rounds: int = 2
    moves: int = 4
    samples: int = 2
    shard_tokens: int = 1 << 21
    bucket_tokens: int = 1 << 22
    spare_bits: int = 12
    seed: int = 11


@dataclass(frozen=True)
class Layout:
    """Where pairs live: buckets, bits of a context, and pieces of every hot word."""

    buckets: int
    bits: int
    seed: int
    hot: np.ndarray  # sorted hashes, at most one for each half bucket of tokens
    pieces: np.ndarray

    def contexts(self, hashes: np.ndarray) -> np.ndarray:
        return (mix64(hashes + np.uint64(0x5BD1E995)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def places(self, hashes: np.ndarray):
        """(first bucket, pieces) of each word."""
        first = (mix64(hashes ^ np.uint64(self.seed)) % np.uint64(self.buckets)).astype(np.int64)
        pieces = np.ones(len(hashes), np.int64)
        at = np.searchsorted(self.hot, hashes)
        is_hot = np.zeros(len(hashes), bool)
        inside = at < len(self.hot)
        is_hot[inside] = self.hot[at[inside]] == hashes[inside]
        pieces[is_hot] = self.pieces[at[is_hot]]
        return first, pieces


def _pack(array: np.ndarray) -> bytes:
    """Compressed bytes of an array, equal byte places together."""
    import zstandard

    planes = np.ascontiguousarray(array.view(np.uint8).reshape(-1, array.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    import zstandard

    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


def _join(parts: list[bytes]) -> bytes:
    return np.array([len(p) for p in parts], "<u4").tobytes() + b"".join(parts)


def _split(data: bytes, count: int) -> list[bytes]:
    sizes = np.frombuffer(data[: 4 * count], "<u4").tolist()
    ends = np.cumsum([4 * count, *sizes]).tolist()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def _pack_rising(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=0).astype("<i8"))


def _unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, "<i8"))


def token_hashes(bodies: list[bytes]):
    """(hash of each token, tokens of each body): lower-cased words, then one end each."""
    data = np.frombuffer(b"\n".join([*bodies, b""]), np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.diff(np.concatenate(([0], (~blank).view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    words = SpanHasher(data).spans(starts, ends)
    closes = np.cumsum(np.fromiter((len(b) + 1 for b in bodies), np.int64, len(bodies)))
    upto = np.searchsorted(starts, closes)
    sizes = np.diff(np.concatenate(([0], upto))) + 1
    out = np.empty(len(words) + len(bodies), np.uint64)
    last = np.cumsum(sizes) - 1
    out[last] = END
    rest = np.ones(len(out), bool)
    rest[last] = False
    out[rest] = words
    return out, sizes


# Shards: the documents of one task as numbers of words.

SHARD = pa.schema([
    ("shard", pa.int64()), ("tokens", pa.int64()), ("frequent", pa.list_(pa.int64())),
    ("times", pa.list_(pa.int64())), ("head", pa.binary()), ("body", pa.binary()),
])
SHARD_DDL = "shard long, tokens long, frequent array<long>, times array<long>, head binary, body binary"


def _shard_row(number: int, ids, train, tokens, sizes):
    """Words by falling frequency and the number of each token's word."""
    words, word, times = np.unique(tokens, return_inverse=True, return_counts=True)
    order = np.argsort(-times, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    words, times = words[order], times[order]
    often = np.searchsorted(-times, -max(64, len(tokens) >> 15), side="right")
    head = _join([
        _pack(np.array([-1 if i is None else i for i in ids], "<i8")),
        _pack(np.array([i is None for i in ids], np.uint8)),
        _pack(np.asarray(train, np.uint8)),
        _pack(np.asarray(sizes, "<u4")),
    ])
    body = _join([_pack(words.astype("<u8")), _pack(place[word].astype("<u4"))])
    frequent = words[:often].view(np.int64).tolist()
    return record_batch(SHARD, [[number], [len(tokens)], [frequent], [times[:often].tolist()], [head], [body]])


def _shards(spec: ModelSpec):
    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, train, tokens, sizes, held = [], [], [], [], 0
        for part in slices(batches):
            found, own = token_hashes(part.column(2).to_pylist())
            ids += part.column(0).to_pylist()
            train += part.column(1).to_pylist()
            tokens.append(found)
            sizes.append(own)
            held += len(found)
            if held >= spec.shard_tokens:
                yield _shard_row(number, ids, train, np.concatenate(tokens), np.concatenate(sizes))
                number += 1
                ids, train, tokens, sizes, held = [], [], [], [], 0
        if ids:
            yield _shard_row(number, ids, train, np.concatenate(tokens), np.concatenate(sizes))

    return run


class Shard:
    """The distinct pairs of a shard, sorted by word and context, and the bucket of each."""

    def __init__(self, head: bytes, body: bytes, layout: Layout):
        own = zip(_split(head, 4), ("<i8", np.uint8, np.uint8, "<u4"))
        self.ids, self.missing, self.train, sizes = (_unpack(x, k) for x, k in own)
        words, word = _split(body, 2)
        words, word = _unpack(words, "<u8"), _unpack(word, "<u4").astype(np.int64)
        self.sizes = sizes.astype(np.int64)
        order = np.argsort(words)
        self.words = words[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        word = place[word]
        of_words = layout.contexts(np.concatenate((self.words, [START])))
        self.contexts, of_words = np.unique(of_words, return_inverse=True)
        before = np.empty(len(word), np.int64)
        before[1:] = of_words[word[:-1]]
        before[np.cumsum(self.sizes) - self.sizes] = of_words[-1]
        pairs, self.pair = np.unique(word * len(self.contexts) + before, return_inverse=True)
        self.word, self.context = pairs // len(self.contexts), pairs % len(self.contexts)
        first, pieces = layout.places(self.words)
        piece = self.contexts[self.context] % pieces[self.word]
        self.bucket = (first[self.word] + piece) % layout.buckets
        #: Pairs by bucket, and inside a bucket by word and context.
        self.order = np.argsort(self.bucket, kind="stable")

    def cells(self):
        """(bucket, head, body) of every bucket that the shard sends pairs to."""
        learns = np.repeat(self.train.astype(bool), self.sizes)
        counts = np.bincount(self.pair[learns], minlength=len(self.word))
        bucket = self.bucket[self.order]
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        for low, high in zip(starts, [*starts[1:], len(bucket)]):
            mine = self.order[low:high]
            words, per_word = np.unique(self.word[mine], return_counts=True)
            contexts, context = np.unique(self.context[mine], return_inverse=True)
            head = _join([_pack(self.words[words].astype("<u8")), _pack(per_word.astype("<u4"))])
            body = _join([
                _pack_rising(self.contexts[contexts]),
                _pack(context.astype("<u4")),
                _pack(counts[mine].astype("<u4")),
            ])
            yield int(bucket[low]), head, body


CELL = pa.schema(
    [("shard", pa.int64()), ("bucket", pa.int32()), ("head", pa.binary()), ("body", pa.binary())]
)
CELL_DDL = "shard long, bucket int, head binary, body binary"


def _cells(layout: Layout):
    def run(batches):
        for batch in batches:
            for number, head, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows = [(number, *cell) for cell in Shard(head, body, layout).cells()]
                yield record_batch(CELL, zip(*rows))

    return run


def _places(layout: Layout):
    """A row (bucket -1) per shard: its documents, and where in the answers each token's pair is."""

    def run(batches):
        for batch in batches:
            for number, head, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                shard = Shard(head, body, layout)
                at = np.empty(len(shard.order), np.int64)
                at[shard.order] = np.arange(len(at))
                packed = _pack(at[shard.pair].astype("<u4"))
                yield record_batch(CELL, [[number], [-1], [head], [packed]])

    return run


# Buckets: the pairs of some words over all shards.


class Bucket:
    """All words of one bucket: their training counts per context, over every shard."""

    def __init__(self, cells: pa.Table, layout: Layout):
        cells = cells.sort_by("shard")
        self.shards = cells.column("shard").to_pylist()
        heads = [_split(x, 2) for x in cells.column("head").to_pylist()]
        bodies = [_split(x, 3) for x in cells.column("body").to_pylist()]
        words = [_unpack(h[0], "<u8") for h in heads]
        self.per_word = [_unpack(h[1], "<u4").astype(np.int64) for h in heads]
        contexts = [_unpack_rising(b[0]) for b in bodies]
        self.words, word = np.unique(np.concatenate(words), return_inverse=True)
        self.contexts, context = np.unique(np.concatenate(contexts), return_inverse=True)
        word_at, context_at = (np.cumsum([0, *map(len, x)]) for x in (words, contexts))
        asked = [
            np.repeat(word[a:b], per_word) * len(self.contexts)
            + context[c:][_unpack(body[1], "<u4").astype(np.int64)]
            for a, b, c, per_word, body in zip(word_at, word_at[1:], context_at, self.per_word, bodies)
        ]
        #: Word and pair numbers that each shard asks for, in its own order.
        self.shard_words = [word[a:b] for a, b in zip(word_at, word_at[1:])]
        pairs, pair = np.unique(np.concatenate(asked), return_inverse=True)
        ends = np.cumsum([0, *map(len, asked)])
        self.shard_pairs = [pair[a:b] for a, b in zip(ends, ends[1:])]
        counts = np.concatenate([_unpack(b[2], "<u4") for b in bodies])
        self.count = np.bincount(pair, counts, len(pairs)).astype(np.int64)
        self.word, self.context = pairs // len(self.contexts), pairs % len(self.contexts)
        self.word_count = np.bincount(self.word, self.count, len(self.words)).astype(np.int64)
        self.hot = np.flatnonzero(np.isin(self.words, layout.hot))
        self.homes = self.contexts % layout.buckets
        #: Pairs whose tables can change.
        self.many = np.flatnonzero(self.count > 1)

    def by_home(self):
        """(home, numbers of its contexts), homes rising."""
        order = np.argsort(self.homes, kind="stable")
        starts = np.flatnonzero(np.diff(self.homes[order], prepend=-1))
        for low, high in zip(starts, [*starts[1:], len(order)]):
            yield int(self.homes[order[low]]), order[low:high]

    def at_root(self, tables):
        return np.bincount(self.word, tables, len(self.words)).astype(np.int64)


def seat(count, others, weight, discount, strength, random):
    """Tables after seating ``count`` customers of each dish one after the other.

    ``others``: tables of the restaurant's other dishes; ``weight``: the parent's probability
    of the dish. A customer opens a table with odds (strength + discount * tables) * weight
    against the customers seated less the discount of their tables. Beyond ``ONE_BY_ONE``
    customers the new tables of a growing step of customers are drawn at once (Poisson).
    It is where a seating begins; Gibbs moves go on from there.
    """
    order = np.argsort(-count, kind="stable")
    c, other, w = count[order], others[order], weight[order]
    t = (c > 0).astype(np.float64)
    k = 1
    while len(c) and k < c[0]:
        n = np.searchsorted(-c, -k)  # dishes with more than k customers
        own = t[:n]
        odds = (strength + discount * (other[:n] + own)) * w[:n]
        chance = odds / (odds + k - discount * own)
        if k < ONE_BY_ONE:
            t[:n] += random.random(n) < chance
            k += 1
        else:
            step = k // 8
            width = np.minimum(step, c[:n] - k)
            t[:n] += np.minimum(random.poisson(chance * width), width)
            k += step
    out = np.empty(len(c))
    out[order] = t
    return out


def _runs(starts, lengths):
    """The numbers start .. start + length - 1 of each run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Seating:
    """Customers at the tables of many dishes; the table sizes of a dish stand together."""

    def __init__(self, tables: np.ndarray, sizes: np.ndarray):
        self.tables, self.sizes = tables.astype(np.int64), sizes.astype(np.int64)
        dish = np.repeat(np.arange(len(tables)), self.tables)
        self.count = np.bincount(dish, self.sizes, len(tables)).astype(np.int64)

    @classmethod
    def opened(cls, count, tables, discount, random):
        """``count`` customers of each dish spread over its ``tables`` tables, none empty."""
        tables = np.minimum(tables, count).astype(np.int64)
        dish = np.repeat(np.arange(len(tables)), tables)
        upto = np.cumsum(random.gamma(1 - discount, size=len(dish)) + 1e-9)
        ends = np.cumsum(tables)
        below = np.where(ends > tables, upto[ends - tables - 1], 0)[dish] if len(dish) else upto
        whole = upto[ends - 1][dish] - below if len(dish) else upto
        share = np.floor((upto - below) / whole * (count - tables)[dish] + 1e-6)
        share[ends[tables > 0] - 1] = (count - tables)[tables > 0]
        first = np.zeros(len(dish), bool)
        first[(ends - tables)[tables > 0]] = True
        return cls(tables, 1 + share - np.where(first, 0, np.roll(share, 1)))

    def _open(self, room):
        """Places of all tables, with ``room`` free ones after those of each dish."""
        self.places = self.tables + room
        self.starts = np.cumsum(self.places) - self.places
        self.size = np.zeros(int(self.places.sum()), np.int64)
        self.size[_runs(self.starts, self.tables)] = self.sizes

    def _close(self):
        self.sizes = self.size[self.size > 0]
        del self.size

    def _leave(self, dishes):
        """One customer of each dish, any with equal chance, leaves; true where a table goes."""
        at = _runs(self.starts[dishes], self.places[dishes])
        upto = np.cumsum(self.size[at])
        count = self.count[dishes]
        ends = np.cumsum(count)
        pick = ends - count + (self.random.random(len(dishes)) * count).astype(np.int64)
        place = at[np.searchsorted(upto, pick, side="right")]
        self.size[place] -= 1
        self.count[dishes] -= 1
        gone = self.size[place] == 0
        self.tables[dishes] -= gone
        return gone

    def _enter(self, dishes, odds, discount):
        """One customer of each dish sits down; true where a table is opened.

        ``odds``: weight of a new table, against customers less discount at each old one.
        """
        lengths = self.places[dishes]
        at = _runs(self.starts[dishes], lengths)
        size = self.size[at]
        weight = np.where(size > 0, size - discount, 0)
        low = np.cumsum(lengths) - lengths
        upto = np.concatenate(([0], np.cumsum(weight)))
        whole = upto[low + lengths] - upto[low]
        draw = self.random.random(len(dishes)) * (whole + odds)
        opens = (draw >= whole) | (self.tables[dishes] == 0)
        free = np.flatnonzero(size == 0)
        new = free[np.searchsorted(free, low[opens])] if opens.any() else free[:0]
        old = np.searchsorted(upto[1:], upto[low[~opens]] + draw[~opens], side="right")
        old = np.clip(old, low[~opens], (low + lengths - 1)[~opens])
        # a sum of floats may end on a free place beside the table meant
        live = np.flatnonzero(size > 0)
        if len(live) and len(old):
            step = np.clip(np.searchsorted(live, old, side="right") - 1, 0, None)
            back = live[step]
            ahead = live[np.minimum(step + 1, len(live) - 1)]
            old = np.where(back >= low[~opens], back, ahead)
        self.size[at[new]] += 1
        self.size[at[old]] += 1
        self.count[dishes] += 1
        self.tables[dishes] += opens
        return opens

    def move(self, restaurant, totals, weight, discount, strength, moves, random):
        """Gibbs: up to ``moves`` customers of each dish leave and sit down again.

        ``totals``: tables of each restaurant, changed in place; ``weight``: the parent's
        probability of each dish. Dishes of one restaurant move side by side.
        """
        self.random = random
        self._open(np.minimum(moves, self.count))
        for k in range(moves):
            dishes = np.flatnonzero(self.count > max(k, 1))
            if not len(dishes):
                break
            where = restaurant[dishes]
            np.subtract.at(totals, where, self._leave(dishes))
            odds = (strength + discount * totals[where]) * weight[dishes]
            np.add.at(totals, where, self._enter(dishes, odds, discount))
        self._close()

    def settle(self, count, total, weight, discount, strength, moves, random):
        """Let customers come and go until each dish has ``count``; returns the tables in all.

        ``total``: tables of the one restaurant. A dish that changes by more than ``moves``
        customers is seated anew.
        """
        self.random = random
        change = count - self.count
        anew = (np.abs(change) > moves) | ((self.count == 0) & (count > 0))
        if anew.any():
            total -= self.tables[anew].sum()
            others = np.full(int(anew.sum()), float(total))
            opened = seat(count[anew], others, np.full(len(others), weight), discount, strength, random)
            fresh = Seating.opened(count[anew], opened, discount, random)
            total += fresh.tables.sum()
            tables = self.tables.copy()
            tables[anew] = fresh.tables
            sizes = np.empty(int(tables.sum()), np.int64)
            starts = np.cumsum(tables) - tables
            sizes[_runs(starts[anew], fresh.tables)] = fresh.sizes
            kept = np.repeat(~anew, self.tables)
            sizes[_runs(starts[~anew], tables[~anew])] = self.sizes[kept]
            self.__init__(tables, sizes)
            change = count - self.count
        self._open(np.maximum(change, 0))
        for k in range(int(np.abs(change).max(initial=0))):
            leaving, coming = np.flatnonzero(-change > k), np.flatnonzero(change > k)
            if len(leaving):
                total -= self._leave(leaving).sum()
            if len(coming):
                odds = np.full(len(coming), (strength + discount * total) * weight)
                total += self._enter(coming, odds, discount).sum()
        self._close()
        return total

    def packed(self) -> bytes:
        return _join([_pack(self.tables.astype("<u4")), _pack(self.sizes.astype("<u4"))])

    @classmethod
    def unpacked(cls, data: bytes):
        return cls(*(_unpack(x, "<u4") for x in _split(data, 2)))


@dataclass(frozen=True)
class Known:
    """What every bucket knows: sums over all words, and the root's customers of hot words.

    ``root_customers``, ``root_tables``, ``hot_customers`` and ``hot_tables`` are of the last
    seating while training, and hold one entry per sample (rows) in the end.
    """

    tokens: int
    words: int
    discount: float
    root_discount: float
    hot_count: np.ndarray
    root_customers: np.ndarray
    root_tables: np.ndarray
    hot_customers: np.ndarray
    hot_tables: np.ndarray

    def parent(self, customers, tables, strength, sample=-1):
        """The root's probability of words with these customers and tables."""
        rest = strength + self.root_discount * self.root_tables[sample]
        return (customers - self.root_discount * tables + rest / (self.words + 1)) / (
            strength + self.root_customers[sample]
        )


# Homes: the tables of each context, added up over the buckets.

ASK = pa.schema([("home", pa.int32()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
ASK_DDL = "home int, bucket int, a binary, b binary"


def _numbers(values) -> bytes:
    return np.asarray(values, "<i8").tobytes()


def _table(rows) -> pa.Table:
    rows = list(rows)
    return pa.Table.from_batches([record_batch(ASK, zip(*rows) if rows else [[]] * 4)], ASK)


def _lists(rows: pa.Table, *names: str):
    """Rows of some columns; a side of a group that is empty may come without columns."""
    return zip(*(rows.column(c).to_pylist() for c in names)) if rows.num_rows else []


def _first(layout: Layout):
    """Customers and distinct words of each context, by home; sums and hot words at home -1."""

    def run(key, cells):
        b, number = Bucket(cells, layout), key[0].as_py()
        cold = np.ones(len(b.words), bool)
        cold[b.hot] = False
        words = b.word_count[cold]
        customers = np.bincount(b.context, b.count, len(b.contexts)).astype(np.int64)
        dishes = np.bincount(b.context[b.count > 0], minlength=len(b.contexts))
        sums = [words.sum(), (words > 0).sum(), (b.count == 1).sum(), (b.count == 2).sum(),
                (words == 1).sum(), (words == 2).sum(), (b.count > 0).sum()]
        hot = [b.words[b.hot].view(np.int64), b.word_count[b.hot], b.at_root(b.count > 0)[b.hot]]
        rows = [(-1, number, _numbers(sums), _numbers(np.concatenate(hot)))]
        for home, mine in b.by_home():
            totals = _join([_pack(customers[mine].astype("<u4")), _pack(dishes[mine].astype("<u4"))])
            rows.append((home, number, _pack_rising(b.contexts[mine]), totals))
        return _table(rows)

    return run


def _reply(samples: int):
    """Customers and tables of all its contexts to each bucket; ``samples`` seatings side by side."""

    def run(key, asked, changes):
        home = key[0].as_py()
        buckets = asked.column("bucket").to_pylist()
        lists = [_unpack_rising(x) for x in asked.column("a").to_pylist()]
        contexts, at = np.unique(np.concatenate(lists), return_inverse=True)
        totals = [_split(x, 2) for x in asked.column("b").to_pylist()]
        customers, dishes = (
            np.bincount(at, np.concatenate([_unpack(t[i], "<u4") for t in totals]), len(contexts))
            for i in range(2)
        )
        tables = np.tile(dishes, (samples, 1))
        for own, more in _lists(changes, "a", "b"):
            where = np.searchsorted(contexts, _unpack_rising(own))
            for s, part in enumerate(_split(more, samples)):
                tables[s, where] += _unpack(part, "<i4")
        ends = np.cumsum([0, *map(len, lists)])
        rows = []
        for bucket, low, high in zip(buckets, ends, ends[1:]):
            mine = at[low:high]
            parts = [_pack(x[mine].astype("<u4")) for x in (customers, *tables)]
            rows.append((home, bucket, _join(parts), b""))
        return _table(rows)

    return run


def _told(b: Bucket, rows: pa.Table, samples: int):
    """(customers, tables of each sample) of the bucket's contexts, and its state row or None."""
    out = np.zeros((samples + 1, len(b.contexts)))
    state, found = None, {}
    for home, x, y in _lists(rows, "home", "a", "b"):
        if home < 0:
            state = (x, y)
        else:
            found[home] = x
    for home, mine in b.by_home():
        out[:, mine] = [_unpack(part, "<u4") for part in _split(found[home], samples + 1)]
    return out[0], out[1:], state


def _pass(layout: Layout, known: Known, spec: ModelSpec, number: int, last: bool):
    """Rounds of moves in every bucket; what changed by context, the state, the sums."""

    def run(key, cells, rows):
        bucket = key[0].as_py()
        b = Bucket(cells, layout)
        random = np.random.default_rng([spec.seed, number, bucket])
        _, (totals,), state = _told(b, rows, 1)
        many, context = b.many, b.context[b.many]
        start = b.at_root(b.count > 0)
        cold = np.ones(len(b.words), bool)
        cold[b.hot] = False
        at_hot = np.searchsorted(layout.hot, b.words[b.hot])
        if state is None:
            at_root, total = start, float(known.root_tables[-1])
            root = Seating.opened(np.where(cold, start, 0), np.where(cold, start > 0, False), 0.5, random)
            pairs = None
        else:
            pairs, root = (Seating.unpacked(x) for x in _split(state[0], 2))
            total = float(known.root_tables[-1])
            tables = (b.count > 0).astype(np.int64)
            tables[many] = pairs.tables
            at_root = b.at_root(tables)
        far = known.hot_customers[-1][at_hot] - at_root[b.hot]  # hot words in other buckets
        base = 1 / (known.words + 1)
        samples = []
        for _ in range(max(spec.rounds, spec.samples if last else 1)):
            customers, opened = at_root.copy(), root.tables.copy()
            customers[b.hot] += far
            opened[b.hot] = known.hot_tables[-1][at_hot]
            parent = known.parent(customers, opened, spec.strength)
            if pairs is None:
                others = np.maximum(0, totals[context] - 1)
                opened = seat(b.count[many], others, parent[b.word[many]], known.discount, spec.strength, random)
                pairs = Seating.opened(b.count[many], opened, known.discount, random)
                np.add.at(totals, context, pairs.tables - 1)
            pairs.move(context, totals, parent[b.word[many]], known.discount, spec.strength, spec.moves, random)
            tables = (b.count > 0).astype(np.int64)
            tables[many] = pairs.tables
            at_root = b.at_root(tables)
            total = root.settle(
                np.where(cold, at_root, 0), total, base, known.root_discount, spec.strength, spec.moves, random
            )
            whole = np.array([total])
            root.move(
                np.zeros(len(b.words), np.int64), whole, np.full(len(b.words), base),
                known.root_discount, spec.strength, spec.moves, random,
            )
            total = float(whole[0])
            samples.append((tables, at_root, root.tables.copy()))
        samples = samples[-spec.samples :] if last else samples[-1:]
        sums = [(at[cold].sum(), opened[cold].sum()) for _, at, opened in samples]
        hot = [b.words[b.hot].view(np.int64), *(at[b.hot] for _, at, _ in samples)]
        out = [(-2, bucket, _numbers(np.concatenate(sums)), _numbers(np.concatenate(hot)))]
        kept = [_pack(x.astype("<u4")) for t, _, opened in samples for x in (t[many], opened)]
        out.append((-1, bucket, _join([pairs.packed(), root.packed()]), _join(kept)))
        changes = np.array([
            np.bincount(context, t[many] - 1, len(b.contexts)).astype("<i4") for t, _, _ in samples
        ])
        for home, mine in b.by_home():
            mine = mine[changes[:, mine].any(axis=0)]
            if len(mine):
                parts = [_pack(np.ascontiguousarray(c[mine])) for c in changes]
                out.append((home, bucket, _pack_rising(b.contexts[mine]), _join(parts)))
        return _table(out)

    return run


def predictive(b: Bucket, layout: Layout, known: Known, spec: ModelSpec, rows: pa.Table) -> np.ndarray:
    """Probability of each pair, averaged over the samples, from replies and state of the bucket."""
    customers, totals, (_, kept) = _told(b, rows, spec.samples)
    kept = [_unpack(x, "<u4").astype(np.int64) for x in _split(kept, 2 * spec.samples)]
    at_hot = np.searchsorted(layout.hot, b.words[b.hot])
    share = np.zeros(len(b.count))
    for s in range(spec.samples):
        tables = (b.count > 0).astype(np.int64)
        tables[b.many], opened = kept[2 * s : 2 * s + 2]
        at_root = b.at_root(tables)
        at_root[b.hot], opened[b.hot] = known.hot_customers[s][at_hot], known.hot_tables[s][at_hot]
        parent = known.parent(at_root, opened, spec.strength, s)
        up = spec.strength + known.discount * totals[s][b.context]
        share += (b.count - known.discount * tables + up * parent[b.word]) / (
            spec.strength + customers[b.context]
        )
    return share / spec.samples


def _answers(layout: Layout, known: Known, spec: ModelSpec):
    """Per shard and bucket: words' training counts, and log10 probability of each asked pair."""

    def run(key, cells, rows):
        b, bucket = Bucket(cells, layout), key[0].as_py()
        logs = np.log10(predictive(b, layout, known, spec, rows)).astype("<f4")
        count = b.word_count.copy()
        count[b.hot] = known.hot_count[np.searchsorted(layout.hot, b.words[b.hot])]
        out = []
        for shard, per_word, words, pairs in zip(b.shards, b.per_word, b.shard_words, b.shard_pairs):
            head = _join([_pack(per_word.astype("<u4")), _pack(count[words].astype("<u8"))])
            out.append((shard, bucket, head, _pack(logs[pairs])))
        return pa.Table.from_batches([record_batch(CELL, zip(*out))], CELL)

    return run


def _estimated(ones: int, twos: int) -> float:
    """Discount from how many dishes have one and two customers."""
    return float(np.clip(ones / max(1, ones + 2 * twos), 0.1, 0.9))


def _hot_sums(layout: Layout, rows, columns: int) -> np.ndarray:
    """Sums over the pieces of each hot word, one row per column."""
    out = np.zeros((columns, len(layout.hot)), np.int64)
    for row in rows:
        words, *values = np.frombuffer(row.b, "<i8").reshape(columns + 1, -1)
        at = np.searchsorted(layout.hot, np.ascontiguousarray(words).view(np.uint64))
        for total, own in zip(out, values):
            np.add.at(total, at, own)
    return out


def _seated_root(layout: Layout, known: Known, rows, spec: ModelSpec, samples: int, number: int) -> Known:
    """The root of each sample: sums over the buckets, and hot words seated here.

    Hot words are as many as half buckets of tokens at most, buckets send one row each.
    """
    sums = np.sum([np.frombuffer(r.a, "<i8") for r in rows], axis=0).reshape(samples, 2)
    customers = _hot_sums(layout, rows, samples)
    random = np.random.default_rng([spec.seed, number])
    opened = np.array([
        seat(c, np.full(len(c), float(t)), np.full(len(c), 1 / (known.words + 1)),
             known.root_discount, spec.strength, random)
        for c, (_, t) in zip(customers, sums)
    ]).reshape(samples, -1)
    return Known(
        known.tokens, known.words, known.discount, known.root_discount, known.hot_count,
        (sums[:, 0] + customers.sum(axis=1)).astype(float), (sums[:, 1] + opened.sum(axis=1)).astype(float),
        customers, opened,
    )


def train(asked: DataFrame, layout: Layout, spec: ModelSpec):
    """(totals, homes, rows of the last pass) after ``spec.passes`` passes over all buckets."""
    buckets = asked.groupBy("bucket")
    first = buckets.applyInArrow(_first(layout), ASK_DDL).repartition(layout.buckets, "home")
    homes = cut_partitioned(first)
    rows = homes.filter("home < 0").collect()
    sums = np.sum([np.frombuffer(r.a, "<i8") for r in rows], axis=0)
    hot_count, hot_customers = _hot_sums(layout, rows, 2)
    words = int(sums[1] + (hot_count > 0).sum())
    known = Known(
        int(sums[0] + hot_count.sum()), words, _estimated(*sums[2:4]), _estimated(*sums[4:6]), hot_count,
        np.array([float(sums[6])]), np.array([float(words)]),
        hot_customers[None], (hot_customers[None] > 0).astype(np.int64),
    )
    homes = homes.filter("home >= 0")
    told = replies(homes, homes.limit(0), 1)
    for number in range(1, spec.passes + 1):
        last = number == spec.passes
        samples = spec.samples if last else 1
        work = _pass(layout, known, spec, number, last)
        done = cut_lineage(buckets.cogroup(told.groupBy("bucket")).applyInArrow(work, ASK_DDL))
        known = _seated_root(layout, known, done.filter("home = -2").collect(), spec, samples, number)
        told = replies(homes, done.filter("home >= 0"), samples).union(done.filter("home = -1"))
    return known, told


def replies(homes: DataFrame, changes: DataFrame, samples: int) -> DataFrame:
    return homes.groupBy("home").cogroup(changes.groupBy("home")).applyInArrow(_reply(samples), ASK_DDL)


def _document_rows(known: Known, schema):
    """Scores of the documents of each shard: its own row, then its answers by bucket."""
    below = known.tokens + known.words + 1

    def finish(own, answers):
        head, body = own
        ids, missing, _, sizes = (
            _unpack(x, k) for x, k in zip(_split(head, 4), ("<i8", np.uint8, np.uint8, "<u4"))
        )
        pair, sizes = _unpack(body, "<u4"), sizes.astype(np.int64)
        counts = []
        for words, _ in answers:
            per_word, count = _split(words, 2)
            counts.append(np.repeat(_unpack(count, "<u8"), _unpack(per_word, "<u4")))
        count = np.concatenate(counts).astype(np.int64)[pair]
        score = np.concatenate([_unpack(p, "<f4") for _, p in answers]).astype(np.float64)[pair]
        starts = np.cumsum(sizes) - sizes
        return record_batch(
            schema,
            [
                pa.array(ids, mask=missing.astype(bool)),
                sizes,
                np.add.reduceat((count > 0).astype(np.int64), starts),
                np.add.reduceat(np.log10((count + 1) / below), starts),
                np.add.reduceat(score, starts),
            ],
        )

    def run(batches):
        shard, own, answers = None, None, []
        for batch in batches:
            for number, bucket, head, body in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if number != shard:
                    if own is not None:
                        yield finish(own, answers)
                    shard, own, answers = number, None, []
                if bucket < 0:
                    own = (head, body)
                else:
                    answers.append((head, body))
        if own is not None:
            yield finish(own, answers)

    return run


def held_out(doc_id):
    """True for the seventh of ids that training never sees; null ids are held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(True))


def laid_out(shards: DataFrame, spec: ModelSpec) -> Layout:
    """Buckets for all tokens, and the words that fill more than half a bucket in pieces."""
    tokens = shards.agg(F.sum("tokens")).head()[0] or 0
    half = max(1, spec.bucket_tokens // 2)
    hot = (
        shards.select(F.explode(F.arrays_zip("frequent", "times")).alias("w"))
        .groupBy(F.col("w.frequent").alias("word"))
        .agg(F.sum("w.times").alias("n"))
        .filter(F.col("n") > half)
        .collect()
    )
    found = np.array([r.word for r in hot], np.int64).view(np.uint64)
    pieces = np.array([-(-r.n // half) for r in hot], np.int64)
    order = np.argsort(found)
    buckets = max(shuffle_partitions(shards.sparkSession), -(-tokens // max(1, spec.bucket_tokens)))
    bits = min(62, int(tokens).bit_length() + spec.spare_bits)
    return Layout(int(buckets), bits, spec.seed, found[order], pieces[order])


def asked_pairs(shards: DataFrame, layout: Layout) -> DataFrame:
    """Every shard's pairs, at their buckets."""
    cells = shards.select("shard", "head", "body").mapInArrow(_cells(layout), CELL_DDL)
    return cut_partitioned(cells.repartition(layout.buckets, "bucket"))


def score_report(docs: DataFrame, spec: ModelSpec = ModelSpec()) -> DataFrame:
    """One row per document: sizes, the add-one unigram score and the model's log10 score.

    Null and empty texts are their end token alone. Without training documents every word is
    unknown and has the uniform share. Repeated rows are scored and counted one by one.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    rows = id_and_bytes(docs).select(
        "doc_id", (~held_out(F.col("doc_id"))).alias("train"), "body"
    )
    rows.mapInArrow(_shards(spec), SHARD_DDL).write.option("compression", "uncompressed").parquet(path)
    shards = spark.read.parquet(path)
    layout = laid_out(shards, spec)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
    schema = pa.schema([*fields, ("base_score", pa.float64()), ("score", pa.float64())])
    ddl = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    asked = asked_pairs(shards, layout)
    if asked.isEmpty():
        scored, tokens = spark.createDataFrame([], ddl), 0
    else:
        known, told = train(asked, layout, spec)
        tokens = known.tokens
        answers = (
            asked.groupBy("bucket")
            .cogroup(told.groupBy("bucket"))
            .applyInArrow(_answers(layout, known, spec), CELL_DDL)
        )
        scored = (
            shards.select("shard", "head", "body")
            .mapInArrow(_places(layout), CELL_DDL)
            .union(answers)
            .repartition(layout.buckets, "shard")
            .sortWithinPartitions("shard", "bucket")
            .mapInArrow(_document_rows(known, schema), ddl)
        )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )

"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import small_table

from .common import mix64, own_columns, record_batch, slices

#: Multiplier of the polynomial word and line hashes; odd, so it can be undone modulo 2^64.
BASE = 0x9E3779B97F4A7C15
FEATURES = (
    "upper", "pipes", "symbols", "marks", "digits", "adjacent", "repeated",
    "log_words", "word_length", "seen_before", "ends_sentence", "starts_upper", "non_letters",
)
WIDTH = 3 * len(FEATURES) + 3


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class SpanHasher:
    """Hashes of byte spans of one buffer; equal spans have equal hashes anywhere."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(n, BASE)[:-1], out=self.sums[1:])
        self.undo = _powers(n, pow(BASE, -1, 1 << 64))

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.undo[starts])


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int8)
    out[list(chars)] = 1
    return out


def _counts(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=sums[1:], dtype=np.int32)
    return (sums[ends] - sums[starts]).astype(np.float64)


def _equal_before(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True where an equal value came before in the same group."""
    order = np.lexsort((value, group))
    same = (group[order][1:] == group[order][:-1]) & (value[order][1:] == value[order][:-1])
    out = np.zeros(len(group), bool)
    out[order[1:][same]] = True
    return out


def line_features(bodies: list[bytes]):
    """(document of each line, its bytes, features): all lines that hold a visible byte.

    Features use the characters of a line alone, and whether the line came before in its
    document; they are computed for all lines of all bodies at once.
    """
    data = np.frombuffer(b"\n".join([*bodies, b""]), np.uint8)
    ends_of = np.cumsum(np.fromiter((len(b) + 1 for b in bodies), np.int64, len(bodies)))
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    visible = ~(((data >= 9) & (data <= 13)) | (data == 32))
    n_bytes = _counts(visible, starts, ends)
    real = n_bytes > 0
    starts, ends, n_bytes = starts[real], ends[real], n_bytes[real]
    owner = np.searchsorted(ends_of, starts, side="right")
    if not len(starts):
        return owner, n_bytes, np.zeros((0, len(FEATURES)), np.float32)

    upper = (data >= 65) & (data <= 90)
    wide_upper = np.zeros(len(data), bool)
    wide_upper[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    lower = np.where(upper, data + 32, data)
    letters = ((lower >= 97) & (lower <= 122)) | (data >= 0xC0)
    edges = np.diff(np.concatenate(([0], visible.view(np.int8), [0])))
    word_at, word_to = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    hasher = SpanHasher(lower)
    words = hasher.spans(word_at, word_to)
    word_line = np.searchsorted(starts, word_at, side="right") - 1
    adjacent = np.zeros(len(words))
    adjacent[1:] = (words[1:] == words[:-1]) & (word_line[1:] == word_line[:-1])
    repeated = _equal_before(word_line, words)
    per_line = lambda x: np.bincount(word_line, x, len(starts))
    n_words = np.maximum(1, per_line(np.ones(len(words))))

    def share(chars: bytes, of):
        return np.sqrt(np.minimum(1, _counts(_table(chars)[data], starts, ends) / of))

    n_letters = np.maximum(1, _counts(letters, starts, ends))
    n_upper = _counts(upper | wide_upper, starts, ends)
    last = data[np.maximum(starts, _last_visible(visible, ends))]
    columns = [
        np.minimum(1, np.maximum(0, n_upper - n_words) / n_letters),
        share(b"|", n_words),
        share(b"#*$%&<>", n_words),
        share(b"!?", n_words),
        share(b"0123456789", n_bytes),
        np.sqrt(per_line(adjacent) / n_words),
        per_line(repeated.astype(float)) / n_words,
        np.minimum(2, np.log1p(n_words) / 4),
        np.minimum(2, n_bytes / n_words / 8),
        _equal_before(owner, hasher.spans(starts, ends)),
        np.isin(last, np.frombuffer(b".!?:;\"'", np.uint8)),
        (upper | wide_upper)[starts],
        np.minimum(1, np.maximum(0, n_bytes - 2 * n_letters) / n_bytes),
    ]
    return owner, n_bytes, np.stack(columns, axis=1).astype(np.float32)


def _last_visible(visible: np.ndarray, ends: np.ndarray) -> np.ndarray:
    at = np.where(visible, np.arange(len(visible)), 0)
    return np.maximum.accumulate(at)[ends - 1]


def with_neighbours(owner: np.ndarray, own: np.ndarray) -> np.ndarray:
    """A line's features, those of the lines before and after it, first, last, constant."""
    n, k = own.shape
    out = np.zeros((n, WIDTH), np.float32)
    out[:, :k] = own
    if n:
        same = owner[1:] == owner[:-1]
        out[1:, k : 2 * k] = own[:-1] * same[:, None]
        out[:-1, 2 * k : 3 * k] = own[1:] * same[:, None]
        out[0, 3 * k] = out[-1, 3 * k + 1] = 1
        out[1:, 3 * k] = ~same
        out[:-1, 3 * k + 1] = ~same
        out[:, 3 * k + 2] = 1
    return out


def chain(owner: np.ndarray, scores: np.ndarray, moves: np.ndarray):
    """Forward-backward on many chains at once, one step per line number.

    ``scores``: log-odds of good from a line's own features; ``moves[y, z]``: weight of y
    followed by z. Returns forward and backward log-odds; their sum is the marginal's.
    """
    n = len(owner)
    heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if n else np.zeros(0, int)
    sizes = np.diff(np.append(heads, n))
    order = np.argsort(-sizes, kind="stable")
    heads, sizes = heads[order], sizes[order]
    ahead, back = np.array(scores, np.float64), np.zeros(n)
    for t in range(1, sizes[0] if n else 0):
        at = heads[: np.searchsorted(-sizes, -t)] + t
        r = ahead[at - 1]
        ahead[at] = scores[at] + np.logaddexp(moves[0, 1], moves[1, 1] + r) - np.logaddexp(
            moves[0, 0], moves[1, 0] + r
        )
    for t in range((sizes[0] if n else 0) - 2, -1, -1):
        at = heads[: np.searchsorted(-sizes, -t - 1)] + t
        v = scores[at + 1] + back[at + 1]
        back[at] = np.logaddexp(moves[1, 0], moves[1, 1] + v) - np.logaddexp(
            moves[0, 0], moves[0, 1] + v
        )
    return ahead, back


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class LineModel:
    """Weights of the field and of the step from mean marginals to a document's score."""

    weights: np.ndarray
    moves: np.ndarray
    slope: float
    offset: float
    prior: float

    def score(self, owner, n_bytes, own, documents: int) -> np.ndarray:
        """Score of each document; one without a visible line gets the share of label 1."""
        mean, weight = self.mean_marginal(owner, n_bytes, own, documents)
        out = sigmoid(self.slope * (mean - 0.5) + self.offset)
        return np.where(weight > 0, out, self.prior)

    def mean_marginal(self, owner, n_bytes, own, documents: int):
        scores = with_neighbours(owner, own) @ self.weights
        marginal = sigmoid(sum(chain(owner, scores, self.moves)))
        weight = np.bincount(owner, n_bytes, documents)
        return np.bincount(owner, marginal * n_bytes, documents) / np.maximum(weight, 1), weight


def _adam(params: np.ndarray, gradient, steps: int, rate: float) -> np.ndarray:
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):
        g = gradient(params)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return params


def train(owner, n_bytes, own, labels: np.ndarray, steps: int = 400, decay: float = 3e-4) -> LineModel:
    """Maximum penalised likelihood; every line carries its document's label.

    ``decay`` keeps weights finite where a feature separates the labels.
    """
    documents = len(labels)
    prior = float((labels.sum() + 0.5) / (documents + 1)) if documents else 0.5
    if not len(owner) or labels.min() == labels.max():
        return LineModel(np.zeros(WIDTH), np.zeros((2, 2)), 0.0, float(np.log(prior / (1 - prior))), prior)
    x = with_neighbours(owner, own).astype(np.float64)
    y = labels[owner].astype(np.float64)
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[pair].astype(int), y[pair + 1].astype(int)), 1)
    n = len(owner)

    def gradient(p):
        w, moves = p[:-4], p[-4:].reshape(2, 2)
        scores = x @ w
        ahead, back = chain(owner, scores, moves)
        g = x.T @ (y - sigmoid(ahead + back))
        a, b = ahead[pair], scores[pair + 1] + back[pair + 1]
        joint = np.stack(
            [np.full(len(pair), moves[0, 0]), moves[0, 1] + b, moves[1, 0] + a, moves[1, 1] + a + b]
        )
        joint = np.exp(joint - joint.max(axis=0))
        expected = (joint / joint.sum(axis=0)).sum(axis=1)
        return np.concatenate([g, seen.ravel() - expected]) / n - decay * p

    p = _adam(np.zeros(WIDTH + 4), gradient, steps, 0.05)
    model = LineModel(p[:-4], p[-4:].reshape(2, 2), 1.0, 0.0, prior)
    mean, weight = model.mean_marginal(owner, n_bytes, own, documents)
    z, target = (mean - 0.5)[weight > 0], labels[weight > 0]

    def fit(q):
        miss = target - sigmoid(q[0] * z + q[1])
        return np.array([miss @ z, miss.sum()]) / len(z) - 1e-5 * q * [1, 0]

    slope, offset = _adam(np.array([4.0, 0.0]), fit, 4000, 0.1)
    return LineModel(model.weights, model.moves, float(slope), float(offset), prior)


def held_out(doc_id):
    """True for the fifth of ids that training never sees; null ids are held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_quality(
    docs: DataFrame, labels: DataFrame, sample: int = 4000, most_lines: int = 400_000
) -> LineModel:
    """Fit on at most ``sample`` labelled documents outside the held-out fifth.

    The sample is the documents with the least hash of their id, the same at any
    partitioning; of these, in the same order, all that fit into ``most_lines`` lines
    together (all rows of an id count, a longer document is passed over). So at most that
    many lines, of a few numbers each, reach the driver. Repeated labels of a document
    count as their least; null labels are left out.
    """
    spark = docs.sparkSession
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("y"))
        .filter(F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("y").cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .collect()
    )
    known = small_table(spark, [tuple(r) for r in chosen], "label_id long, y int")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n")))
    lines = dict(
        texts.join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))  # at most `sample` rows
        .groupBy("doc_id")
        .agg(F.sum(breaks + 1))
        .collect()
    )
    fitting, room = [], most_lines
    for r in chosen:
        if lines.get(r.doc_id, 0) <= room:
            room -= lines.get(r.doc_id, 0)
            fitting.append(tuple(r))
    known = small_table(spark, fitting, "label_id long, y int")
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("bytes", pa.list_(pa.float64())), ("own", pa.list_(pa.float32()))])

    def run(batches):
        for part in slices(batches):
            owner, n_bytes, own = line_features(part.column(2).to_pylist())
            cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
            yield record_batch(
                schema,
                [
                    part.column(0),
                    part.column(1),
                    [n_bytes[a:b] for a, b in zip(cuts, cuts[1:])],
                    [own[a:b].ravel() for a, b in zip(cuts, cuts[1:])],
                ],
            )

    rows = (
        texts.join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))  # at most `sample` rows
        .select("doc_id", "y", F.col("text").cast("binary").alias("body"))
        .mapInArrow(run, "doc_id long, y int, bytes array<double>, own array<float>")
        .toArrow()
        .sort_by("doc_id")
    )
    y = np.array(rows["y"].to_pylist(), np.int64)
    sizes = [len(b) for b in rows["bytes"].to_pylist()]
    owner = np.repeat(np.arange(len(y)), sizes)
    n_bytes = np.array([b for x in rows["bytes"].to_pylist() for b in x], np.float64)
    own = np.array([v for x in rows["own"].to_pylist() for v in x], np.float32)
    return train(owner, n_bytes, own.reshape(-1, len(FEATURES)), y)


def score_quality(docs: DataFrame, model: LineModel, column: str = "score") -> DataFrame:
    """The documents, all columns kept, with their score in ``column``.

    Null and empty texts get the share of label 1 among the training documents. An existing
    column of that name is replaced.
    """
    kept = docs.drop(column)
    rows = kept.select(F.struct(*own_columns(kept)).alias("own"), F.lit(0.0).alias("score"))

    def run(batches):
        for part in slices(batches):
            texts = pc.struct_field(part.column(0), "text")
            bodies = texts.cast(pa.binary()).fill_null(b"").to_pylist()
            score = model.score(*line_features(bodies), len(bodies))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], names=["own", "score"])

    scored = rows.mapInArrow(run, rows.schema)
    return scored.select("own.*", F.col("score").alias(column))


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = fit_quality(docs, labels)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return score_quality(narrow, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents whose score reaches ``threshold``, with their own columns alone."""
    scored = score_quality(docs.drop("quality_score"), fit_quality(docs, labels), "quality_score")
    return scored.filter(F.col("quality_score") >= threshold).select(*own_columns(docs))

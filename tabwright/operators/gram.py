"""Correlations of many columns from Gram matrices of column blocks, in one pass.

Every task turns its Arrow batches into matrices and adds up products of all pairs of columns,
centred on the mean of its first values. Blocks of these sums meet by pair of blocks as means and
products about them, which merge whatever the centres were, and become correlations. A task
holds six numbers for each pair of columns, 48 k² bytes.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns of a block.
BLOCK = 64
SUMS = "left_block int, right_block int, body binary"
CELLS = "left string, right string, correlation double"


def batch_matrix(batch) -> np.ndarray:
    """A batch of doubles as a matrix with a row for each column, missing as NaN."""
    return np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


def column_moments(x: np.ndarray, seen: np.ndarray):
    """(mean, least, greatest) of each column; 0, inf and -inf where nothing was seen."""
    with np.errstate(invalid="ignore", over="ignore"):
        mean = np.where(seen, x, 0.0).sum(1) / np.maximum(seen.sum(1), 1)
    return mean, np.where(seen, x, np.inf).min(1), np.where(seen, x, -np.inf).max(1)


class PairSums:
    """For every pair (i, j), over rows where both have a value: rows, sum and squares of i and
    products, all about ``centre``, and a lesser and a greater value of i once it varies."""

    def __init__(self, width: int):
        k = width
        self.centre = np.full(k, np.nan)
        self.n, self.s, self.q, self.xy = (np.zeros((k, k)) for _ in range(4))
        self.low, self.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)

    def add(self, x: np.ndarray) -> None:
        """Add rows, given by column; ``x`` is overwritten."""
        seen = ~np.isnan(x)
        count = seen.sum(1)
        full = count == x.shape[1]
        gaps = np.flatnonzero(~full)
        self._look(x, seen, full)
        with np.errstate(invalid="ignore", over="ignore"):
            x -= np.nan_to_num(self.centre)[:, None]
            x[~seen] = 0.0
            squares = x * x
            # a column without gaps shares the rows of every other column
            np.add(self.n, count[:, None], out=self.n, where=full)
            np.add(self.s, x.sum(1)[:, None], out=self.s, where=full)
            np.add(self.q, squares.sum(1)[:, None], out=self.q, where=full)
            if len(gaps):
                present = seen.astype(float)
                for some in np.split(gaps, range(BLOCK, len(gaps), BLOCK)):
                    m = present[some].T
                    self.n[:, some] += present @ m
                    self.s[:, some] += x @ m
                    self.q[:, some] += squares @ m
            self.xy += x @ x.T
            # an infinite value leaves no correlation, not even over rows that lack it
            self.q[~np.isfinite(x.sum(1))] = np.nan

    def _look(self, x, seen, full) -> None:
        """Centres of columns that had no values before, and pairs not yet known to vary."""
        fixed = ~(self.low < self.high)
        looked = np.flatnonzero(fixed.any(1))
        if not len(looked):
            return
        low, high = np.full(len(full), np.inf), np.full(len(full), -np.inf)
        mean, low[looked], high[looked] = column_moments(x[looked], seen[looked])
        new = np.isnan(self.centre[looked]) & seen[looked].any(1)
        self.centre[looked[new]] = np.where(np.isfinite(mean), mean, 0.0)[new]
        np.minimum(self.low, low[:, None], out=self.low, where=full)
        np.maximum(self.high, high[:, None], out=self.high, where=full)
        for j in np.flatnonzero(~full):
            some = np.flatnonzero(fixed[:, j])
            if len(some) and seen[j].any():
                _, least, most = column_moments(x[some][:, seen[j]], seen[some][:, seen[j]])
                self.low[some, j] = np.minimum(self.low[some, j], least)
                self.high[some, j] = np.maximum(self.high[some, j], most)

    def blocks(self):
        """(left block, right block, body): both directions of a pair of blocks together."""
        k = len(self.centre)
        centre = np.nan_to_num(self.centre)
        spans = [slice(a, min(a + BLOCK, k)) for a in range(0, k, BLOCK)]
        for i, a in enumerate(spans):
            for j in range(i, len(spans)):
                b = spans[j]
                n, sx, sy = self.n[a, b], self.s[a, b], self.s[b, a].T
                with np.errstate(all="ignore"):
                    x, y = sx / np.maximum(n, 1), sy / np.maximum(n, 1)
                    parts = [n, self.xy[a, b] - sx * y, centre[a, None] + x, centre[b] + y]
                    parts += [self.q[a, b] - sx * x, self.q[b, a].T - sy * y]
                parts += [v for m in (self.low, self.high) for v in (m[a, b], m[b, a].T)]
                yield i, j, np.stack(parts).tobytes()


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Two stacks of block sums as one: rows, products, means and squares of both columns about
    the means, least and greatest values."""
    n = one[0] + other[0]
    with np.errstate(all="ignore"):
        share = other[0] / np.maximum(n, 1)
        x, y = other[2] - one[2], other[3] - one[3]
        both = one[0] * share
        sums = [n, one[1] + other[1] + x * y * both, one[2] + x * share, one[3] + y * share]
        sums += [one[4] + other[4] + x * x * both, one[5] + other[5] + y * y * both]
    return np.concatenate(
        [np.stack(sums), np.minimum(one[6:8], other[6:8]), np.maximum(one[8:], other[8:])]
    )


def block_correlations(body: np.ndarray) -> np.ndarray:
    """Pearson correlation of each pair; NaN where either column does not vary."""
    _, xy, _, _, qx, qy, lowx, lowy, highx, highy = body
    with np.errstate(all="ignore"):
        spread = np.sqrt(np.maximum(qx, 0) * np.maximum(qy, 0))
        r = xy / spread
    sound = (lowx < highx) & (lowy < highy) & (spread > 0)
    return np.where(sound, np.clip(r, -1, 1), np.nan)


def blocked_correlations(data: DataFrame, columns) -> DataFrame:
    """(left, right, correlation) for every pair of the columns of doubles ``data``, both orders
    and the diagonal; NULL where either column is constant over the rows of the pair or holds
    infinite values."""
    names = list(columns)
    width = len(names)

    def add_up(batches):
        sums = PairSums(width)
        for batch in batches:
            if batch.num_rows:
                sums.add(batch_matrix(batch))
        for left, right, body in sums.blocks():
            yield pa.RecordBatch.from_arrays(
                [pa.array([left], pa.int32()), pa.array([right], pa.int32()), pa.array([body], pa.binary())],
                names=["left_block", "right_block", "body"],
            )

    def finish(batches):
        now, total = None, None

        def cells():
            left, right = (names[b * BLOCK : (b + 1) * BLOCK] for b in now)
            r = block_correlations(total)
            pairs = []
            for i, a in enumerate(left):
                for j, b in enumerate(right):
                    if now[0] == now[1] and a == b:
                        pairs.append((a, b, None if np.isnan(r[i, j]) else 1.0))
                        continue
                    v = None if np.isnan(r[i, j]) else float(r[i, j])
                    pairs.append((a, b, v))
                    if now[0] != now[1]:
                        pairs.append((b, a, v))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*pairs), (pa.string(), pa.string(), pa.float64()))],
                names=["left", "right", "correlation"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                key = row["left_block"], row["right_block"]
                shape = [min(BLOCK, width - b * BLOCK) for b in key]
                body = np.frombuffer(row["body"]).reshape(10, *shape)
                if key != now:
                    if now is not None:
                        yield cells()
                    now, total = key, body
                else:
                    total = merged(total, body)
        if now is not None:
            yield cells()

    blocks = data.mapInArrow(add_up, SUMS)
    return (
        blocks.repartition("left_block", "right_block")
        .sortWithinPartitions("left_block", "right_block")
        .mapInArrow(finish, CELLS)
    )

"""Exact percentiles without gathering a column in one task.

``percentile`` and ``median`` keep every distinct value of a column in one
aggregation buffer. Here values are counted and ranked by a running sum, one
task per column, only where the checked number of rows is small. Larger columns
are narrowed first: a sketch proposes a bracket around each wanted rank, one
aggregate counts the rows below and at its ends, and the bracket is replaced by
the open interval that holds the rank. Each round keeps a small fraction of the
rows and always drops the end values themselves, so a value that holds a third
of the column resolves at once. The driver sees a few numbers per wanted rank.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions import to_number
from tabwright.operators.schema import quoted, require_columns
from tabwright.session import small_table

# Rows of a column (or of a narrowed interval) that one ranking task may get.
SMALL_COLUMN_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000


class _Interval:
    """Open value interval of one column and the wanted sorted positions in it."""

    def __init__(self, column, low, high, below, inside, places):
        self.column, self.low, self.high = column, low, high
        self.below, self.inside = below, inside
        self.places = sorted(places)

    def values(self):
        """The column where it lies inside, else NULL."""
        c = quoted(self.column)
        test = c.isNotNull()
        if self.low is not None:
            test = test & (c > F.lit(self.low))
        if self.high is not None:
            test = test & (c < F.lit(self.high))
        return F.when(test, c)

    def split_at(self, place, left, right, counts):
        """(value, None) when ``place`` falls on an end, else (None, interval).

        ``counts`` are the rows ``< left, <= left, < right, <= right``.
        """
        to, over, until, past = counts
        if place < to:
            return None, (self.low, left, self.below, to - self.below)
        if place < over:
            return left, None
        if place < until:
            return None, (left, right, over, until - over)
        if place < past:
            return right, None
        return None, (right, self.high, past, self.below + self.inside - past)


def _numbers(df: DataFrame, columns) -> DataFrame:
    require_columns(df, columns, "percentiles")
    types = {f.name: f.dataType for f in df.schema.fields}
    # + 0.0 makes -0.0 and 0.0 the same value
    return df.select(
        *[
            (to_number(quoted(c), types[c]).cast("double") + F.lit(0.0)).alias(c)
            for c in columns
        ]
    )


def _narrow(df: DataFrame, intervals, found: dict) -> list:
    """One sketch pass and one counting pass; returns the smaller intervals."""
    slack = 2.0 / SKETCH_ACCURACY
    sketches = []
    for i, v in enumerate(intervals):
        ends = []
        for place in v.places:
            at = (place - v.below + 0.5) / v.inside
            ends += [max(0.0, at - slack), min(1.0, at + slack)]
        sketches.append(
            F.percentile_approx(
                v.values(), F.array(*[F.lit(e) for e in ends]), F.lit(SKETCH_ACCURACY)
            ).alias(f"s{i}")
        )
    ends = df.agg(*sketches).first()
    marks = {}
    for i, v in enumerate(intervals):
        for end in ends[f"s{i}"]:
            marks.setdefault((v.column, end), len(marks))
    seen = df.agg(
        *[
            F.count_if(test).alias(f"n{k}_{j}")
            for (c, end), k in marks.items()
            for j, test in enumerate((quoted(c) < F.lit(end), quoted(c) <= F.lit(end)))
        ]
    ).first()

    def counted(column, end):
        k = marks[column, end]
        return seen[f"n{k}_0"], seen[f"n{k}_1"]

    smaller = {}
    for i, v in enumerate(intervals):
        for j, place in enumerate(v.places):
            left, right = ends[f"s{i}"][2 * j : 2 * j + 2]
            value, inner = v.split_at(
                place, left, right, counted(v.column, left) + counted(v.column, right)
            )
            if inner is None:
                found[v.column, place] = value
            else:
                smaller.setdefault((v.column, *inner), []).append(place)
    return [_Interval(*key, places) for key, places in smaller.items()]


def _pick(df: DataFrame, intervals, found: dict) -> None:
    """Resolve intervals of checked size: count per value, then a running sum
    over the values of one interval."""
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("part"), v.values().alias("value"))
            for i, v in enumerate(intervals)
        ]
    )
    running = (
        df.select(F.inline(entries))
        .filter("value is not null")
        .groupBy("part", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(Window.partitionBy("part").orderBy("value")))
    )
    width = max(len(v.places) for v in intervals)

    def wanted(j):
        lists = [[p - v.below for p in v.places] for v in intervals]
        padded = [F.lit(x[min(j, len(x) - 1)]).cast("bigint") for x in lists]
        return F.element_at(F.array(*padded), F.col("part") + 1)

    rows = running.groupBy("part").agg(
        *[F.min(F.when(F.col("upto") > wanted(j), F.col("value"))).alias(f"v{j}") for j in range(width)]
    )
    for row in rows.collect():
        v = intervals[row["part"]]
        for j, place in enumerate(v.places):
            found[v.column, place] = row[f"v{j}"]


def exact_percentiles(
    df: DataFrame, columns, probabilities, *, small_rows: int = SMALL_COLUMN_ROWS, sizes=None
) -> dict:
    """{column: [value per probability]} with linear interpolation.

    NULL and NaN are ignored; a column without values gives ``None`` entries. ``sizes``, the
    number of values per column, is counted unless given.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    data = _numbers(df, columns)
    if sizes is None:
        sizes = data.agg(*[F.count(quoted(c)).alias(c) for c in columns]).first().asDict()
    spots = {
        (c, j): p * (sizes[c] - 1)
        for c in columns
        if sizes[c]
        for j, p in enumerate(probabilities)
    }
    places = {}
    for (c, _), spot in spots.items():
        places.setdefault(c, set()).update((math.floor(spot), math.ceil(spot)))
    open_ = [_Interval(c, None, None, 0, sizes[c], p) for c, p in places.items()]
    small, found = [], {}
    while open_:
        small += [v for v in open_ if v.inside <= small_rows]
        large = [v for v in open_ if v.inside > small_rows]
        open_ = _narrow(data, large, found) if large else []
    if small:
        _pick(data, small, found)

    result = {c: [None] * len(probabilities) for c in columns}
    for (c, j), spot in spots.items():
        k = math.floor(spot)
        low, high = found[c, k], found[c, math.ceil(spot)]
        result[c][j] = low if low == high else low + (high - low) * (spot - k)
    return result


def exact_medians(df: DataFrame, columns, **options) -> dict:
    """{column: median}, the mean of the two middle values for even counts."""
    found = exact_percentiles(df, columns, [0.5], **options)
    return {c: v[0] for c, v in found.items()}


def percentiles_table(df: DataFrame, columns, probabilities, **options) -> DataFrame:
    """(column, probability, value) of :func:`exact_percentiles`."""
    found = exact_percentiles(df, columns, probabilities, **options)
    rows = [
        (c, float(p), v) for c, values in found.items() for p, v in zip(probabilities, values)
    ]
    return small_table(df.sparkSession, 
        rows, "column string, probability double, value double"
    )

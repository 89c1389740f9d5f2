"""Connected components of an edge table, by rounds of large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the least of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("n"), F.least("a", "m").alias("m")
    )
    return (
        both.filter(F.col("b") > F.col("a"))
        .join(least, F.col("a") == F.col("n"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
    own = least.select(F.col("n").alias("a"), F.col("m").alias("b"))
    rest = (
        down.join(least, F.col("a") == F.col("n"))
        .filter("b <> m")
        .select("b", "m")
        .toDF("a", "b")
    )
    return own.union(rest).distinct()


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, label): for every node of an edge (a, b), the least node of its component.

    Every round is written to the shared checkpoint folder. The steps keep one edge per
    node and neighbour minimum, so a star around one node stays linear in its nodes; both
    groupings combine in the map tasks. Ends when a round changes nothing, which a count
    and an order-free sum of hashes show.
    """

    def mark(frame):
        got = frame.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).head()
        return tuple(got)

    now = cut_lineage(edges.filter("a <> b").select("a", "b").distinct())
    seen = mark(now)
    while seen[0]:
        now = cut_lineage(_small_star(_large_star(now)))
        last, seen = seen, mark(now)
        if last == seen:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)

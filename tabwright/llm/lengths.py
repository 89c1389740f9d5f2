"""Exact histogram of encoded lengths and what follows from its sums."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.session import cut_lineage

from .common import id_and_bytes, record_batch, slices
from .encode import WordEncoder, tokenizer_path


def encoded_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens): ids of each whole text, no special ids added."""
    path = path or tokenizer_path()
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        encoder = WordEncoder(path)
        for part in slices(batches, 2 << 20):
            found = encoder.encode(part.column(1).to_pylist())
            yield record_batch(schema, [part.column(0), [len(x) // 4 for x in found]])

    return id_and_bytes(docs).mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs), one row per distinct length."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def every_limit(histogram: DataFrame) -> DataFrame:
    """(context_limit): 1, 2, … up to the longest text, which no larger limit cuts."""
    longest = histogram.agg(F.max("n_tokens")).head()[0] or 0
    return histogram.sparkSession.range(1, longest + 1).select(F.col("id").alias("context_limit"))


def limit_table(histogram: DataFrame, limits: DataFrame | None = None, block: int = 1024) -> DataFrame:
    """For every distinct length and each of ``limits``, taken as context limit, what a planner asks.

    ``limits`` (context_limit) may hold any limits; each gets one exact row, whether a text has
    that length or not. Null limits are left out, repeated ones count once.
    ``docs_at_least``, ``tokens_at_least``: suffix sums over lengths at or above the limit.
    ``truncated_tokens``: tokens left when every document is cut at the limit.
    ``lost_tokens``: what that cut takes away. ``rank_fraction``: share of documents at or
    below the limit, from which any quantile is read; ``percentile``: the same in whole per cent,
    rounded down, in integers. Suffix sums run inside blocks of ``block`` lengths; block totals
    are summed apart, so no task sees the whole histogram. An empty table gives no rows.
    """
    all_docs, all_tokens = histogram.agg(
        F.sum("n_docs"), F.sum(F.col("n_tokens") * F.col("n_docs"))
    ).head()
    if limits is not None:
        asked = limits.select(F.col("context_limit").cast("long").alias("n_tokens"), F.lit(0).cast("long"))
        histogram = (
            histogram.select(F.col("n_tokens").cast("long"), "n_docs")
            .union(asked.filter(F.col("n_tokens").isNotNull() & F.lit(bool(all_docs))))
            .groupBy("n_tokens")
            .agg(F.sum("n_docs").alias("n_docs"))
        )
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / block)).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs")
    )
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        rows.groupBy("block")
        .agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
        .select(
            "block",
            F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
            F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
        )
    )
    own = (
        Window.partitionBy("block")
        .orderBy(F.desc("n_tokens"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("d", F.sum("n_docs").over(own))
        .withColumn("t", F.sum("tokens").over(own))
        .join(blocks, "block")
        .select(
            F.col("n_tokens").alias("context_limit"),
            "n_docs",
            (F.col("d") + F.col("docs_after")).alias("docs_at_least"),
            (F.col("t") + F.col("tokens_after")).alias("tokens_at_least"),
            F.lit(all_docs).cast("long").alias("all_docs"),
            F.lit(all_tokens).cast("long").alias("all_tokens"),
        )
        .withColumn(
            "truncated_tokens",
            F.col("all_tokens")
            - F.col("tokens_at_least")
            + F.col("context_limit") * F.col("docs_at_least"),
        )
        .withColumn("lost_tokens", F.col("all_tokens") - F.col("truncated_tokens"))
        .withColumn("upto", F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs"))
        .withColumn("rank_fraction", F.col("upto") / F.col("all_docs"))
        .withColumn("percentile", F.expr("100 * upto div all_docs"))
        .drop("upto")
    )


def quantile_lengths(limits: DataFrame, shares) -> DataFrame:
    """(share, n_tokens): the least length that ``share`` of the documents do not exceed."""
    return limits.select(F.explode(F.array(*map(F.lit, shares))).alias("share"), "*").filter(
        F.col("rank_fraction") >= F.col("share")
    ).groupBy("share").agg(F.min("context_limit").alias("n_tokens"))


def length_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The limit table of whole texts for every limit; null texts count as empty (length 0).

    There is a row for each limit from 1 to the longest text, and for 0 if a text is empty. The
    histogram is written once to the shared checkpoint folder, since the table reads it for
    the limits, the suffix sums and the totals.
    """
    histogram = cut_lineage(length_histogram(encoded_lengths(docs, path)))
    return limit_table(histogram, every_limit(histogram))

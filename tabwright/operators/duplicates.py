"""Whole-row duplicates.

Counting repeats of wide rows by a plain ``distinct`` shuffles every byte of
the table. Here only a 64-bit hash per row is shuffled first; rows whose hash
is unique cannot be repeats. The few rows that share a hash are then compared
in full, so the count is exact and hash collisions do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.schema import quoted
from tabwright.session import settle_any, small_table

# Hashes broadcast at most: 4 million rows of 8 bytes.
BROADCAST_ROWS = 4_000_000


def _positional(df: DataFrame):
    """Columns renamed by position so repeated or odd names are no trouble."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), names


def shared_hashes(df: DataFrame, names) -> DataFrame:
    return (
        df.select(F.xxhash64(*names).alias("row_hash"))
        .groupBy("row_hash")
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("row_hash")
    )


def repeated_rows(df: DataFrame) -> DataFrame:
    """Every row value that occurs more than once, with its ``copies``."""
    source = df
    df, names = _positional(df)
    hashes, size = settle_any(shared_hashes(df, names))
    if size == 0:
        empty = small_table(source.sparkSession, [], source.schema)
        return empty.withColumn("copies", F.lit(0).cast("bigint"))
    suspects = df
    if size <= BROADCAST_ROWS:
        suspects = df.withColumn("row_hash", F.xxhash64(*names)).join(
            F.broadcast(hashes), "row_hash", "left_semi"
        )
    # with more shared hashes all rows are grouped: copies combine in the map tasks,
    # where a join would send every copy of a row to one task
    return (
        suspects.groupBy(*names)
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
        .toDF(*source.columns, "copies")
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row ``duplicate_rows``: rows equal to an earlier row over all columns.

    Missing equals missing.
    """
    if not df.columns:
        return small_table(df.sparkSession, [(0,)], "duplicate_rows bigint")
    repeats = repeated_rows(df)
    return repeats.agg(
        F.coalesce(F.sum(quoted("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """One row per distinct row, for tables in which repeats are rare.

    Only rows that share a hash are grouped; all others pass without a shuffle.
    With too many shared hashes to broadcast, all rows are grouped.
    """
    named, names = _positional(df)
    hashes, size = settle_any(shared_hashes(named, names))
    if size == 0:
        return df
    if size > BROADCAST_ROWS:
        return df.dropDuplicates()
    marked = named.withColumn("row_hash", F.xxhash64(*names))
    hashes = F.broadcast(hashes)
    once = marked.join(hashes, "row_hash", "left_anti").select(*names)
    repeated = marked.join(hashes, "row_hash", "left_semi").select(*names).dropDuplicates()
    return once.unionByName(repeated).toDF(*df.columns)

"""Gap-free row numbers without a single-task window."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.schema import quoted
from tabwright.session import cut_lineage, settle_any, small_table

#: File ranges whose offsets are broadcast; a table of more is numbered by ``number_rows``.
MOST_RANGES = 200_000


def number_rows(df: DataFrame, name: str = "source_row", start: int = 0, order_by=()) -> DataFrame:
    """Add consecutive numbers from ``start``.

    With ``order_by`` the numbers follow a distributed range sort; otherwise the
    order of the input partitions. Rows get (partition, position) marks, the
    marked table is fixed by a reliable checkpoint so both later reads see the
    same marks, and each partition is shifted by the rows before it.
    """
    if name in df.columns:
        raise ValueError(f"column {name!r} is already in the table")
    mark = F.monotonically_increasing_id()
    if order_by:
        # the mark as last sort key spreads copies of a hot key over tasks
        df = df.withColumn("mark_", mark).sort(*[quoted(c) for c in order_by], "mark_").drop("mark_")
    marked = cut_lineage(df.withColumn("mark_", mark))
    part = F.shiftright("mark_", 33)
    sizes = marked.groupBy(part.alias("part_")).agg(F.count("*").alias("n"))
    # one small row per partition of the table
    counted = sorted((r["part_"], r["n"]) for r in sizes.collect())
    offsets, before = [], start
    for p, n in counted:
        offsets.append((p, before))
        before += n
    table = small_table(df.sparkSession, offsets, "part_ bigint, before_ bigint")
    position = F.col("mark_").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        marked.withColumn("part_", part)
        .join(F.broadcast(table), "part_")
        .select(
            (F.col("before_") + position).alias(name),
            *[quoted(c) for c in df.columns if c != "mark_"],
        )
    )


def number_scan_rows(df: DataFrame, name: str = "source_row", start: int = 0) -> DataFrame:
    """``number_rows`` in file order for a table that is read from files and not shuffled since.

    Rows keep their order: by file path, then by place in the file. Tasks read ranges of files,
    so a narrow pass counts the rows of each range (no column but those that filters read), and
    a row's number is its place in its range plus the rows of all ranges before: one row per
    range is broadcast, and no column of the table is written or shuffled. Tables without file
    metadata, such as unions, and those of more than ``MOST_RANGES`` ranges go through
    ``number_rows``.
    """
    if name in df.columns:
        raise ValueError(f"column {name!r} is already in the table")
    try:
        placed = df.select(
            *[quoted(c) for c in df.columns],
            F.struct("_metadata.file_path", "_metadata.file_block_start").alias("range_"),
        )
    except AnalysisException:
        return number_rows(df, name, start)
    # read again, the files are cut into the same ranges, which fill the same partitions
    marked = placed.withColumn("mark_", F.monotonically_increasing_id())
    counted = marked.groupBy("range_").agg(F.min("mark_").alias("first"), F.count("*").alias("n"))
    ranges, rows = settle_any(counted, MOST_RANGES)
    if rows > MOST_RANGES:
        return number_rows(df, name, start)
    earlier = Window.partitionBy(F.lit(0)).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        F.col("range_").alias("own_range_"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + start).alias("shift_"),
    )
    return marked.join(F.broadcast(offsets), F.col("range_") == F.col("own_range_")).select(
        (F.col("mark_") + F.col("shift_")).alias(name), *[quoted(c) for c in df.columns]
    )

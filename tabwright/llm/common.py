"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.schema import quoted
from tabwright.session import cut_lineage

#: Fixed value: what separates words in every contract of this subpackage.
SPACE = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_columns(docs: DataFrame, *without: str):
    """All columns of a table, whatever characters their names hold."""
    return [quoted(c) for c in docs.columns if c not in without]


def id_and_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, body): the id and the text as UTF-8 bytes; a null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body"),
    )


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id, body): the id and the text; a null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"),
    )


def slices(batches, most_bytes: int = 1 << 20):
    """Cut Arrow batches so that each part holds about ``most_bytes``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        each = max(1, int(batch.num_rows * most_bytes / max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, each):
            yield batch.slice(start, each)


def record_batch(schema: pa.Schema, columns) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit values (the finaliser of the public SplitMix64 generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def cut_partitioned(df: DataFrame) -> DataFrame:
    """A reliable checkpoint that keeps the hash partitioning of ``df``.

    An adaptive plan does not tell its partitioning before it ran, so the rows are written
    under a fixed plan; later groupings by the same column then need no shuffle.
    """
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return cut_lineage(df)
    finally:
        conf.set(name, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def kept_by_worker(key, make):
    """``make()`` once in the life of a Python worker; later tasks find it again.

    Functions shipped by value get new globals with every task, so what is costly to build is
    kept in a module of its own.
    """
    name = "kept_by_worker_"
    if name not in sys.modules:
        sys.modules[name] = ModuleType(name)
        sys.modules[name].found = {}
    found = sys.modules[name].found
    if key not in found:
        found[key] = make()
    return found[key]

"""Session settings and shared scratch space."""

from __future__ import annotations

import math
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# ANSI stays on (bad casts must be handled by try_* functions, never hidden),
# timestamps are read in UTC, names keep their case as in the source files.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Rows of one task of work that takes long for every row.
TASK_ROWS = 20_000


def build_session(app_name="tabwright", master=None, **extra):
    """A session with the recommended settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from ``spark.checkpoint.dir``; a machine-local folder is only set up
    where nothing is configured, which is the case in local tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="tabwright-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for an intermediate table."""
    return f"{shared_dir(spark)}/tabwright-{uuid.uuid4().hex}/{name}"


def cut_lineage(df):
    """Materialise ``df`` once in the shared folder (reliable checkpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df, rows: int, task_rows: int = TASK_ROWS):
    """``df`` of ``rows`` rows dealt out anew, so that no task has many more than ``task_rows``.

    The number of tasks follows from the rows alone; a table for one task stays as it is.
    """
    return df.repartition(math.ceil(rows / task_rows)) if rows > task_rows else df


def small_table(spark: SparkSession, rows, schema):
    """A few driver-side rows as a local relation (no RDD, no Python workers)."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.names
    records = [dict(zip(names, r)) for r in rows]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema=schema)


def settle(frame, rows: int, driver_rows: int = 50_000):
    """Fix a small result so later plans do not compute it again.

    ``rows`` is its checked size: small results become a local relation, larger
    ones a reliable checkpoint.
    """
    if rows <= driver_rows:
        return frame.sparkSession.createDataFrame(frame.toArrow(), schema=frame.schema)
    return cut_lineage(frame)


def settle_any(frame, driver_rows: int = 50_000):
    """(fixed frame, rows) of a result whose size is not known yet."""
    head = frame.limit(driver_rows + 1).toArrow()
    if head.num_rows <= driver_rows:
        return frame.sparkSession.createDataFrame(head, schema=frame.schema), head.num_rows
    fixed = cut_lineage(frame)
    return fixed, fixed.count()

"""The raw zone: byte-true copies of files, or snapshots of tables with unchanged values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators.schema import repeated_names
from tabwright.sources.files import exists, protect_outputs
from tabwright.sources.rawbytes import WHOLE_BYTES, copy_bytes, file_digests
from tabwright.sources.tables import CSV, read_table, table_format, whole_csv


def snapshot(spark, source: str, destination: str, *, overwrite=False, multiline=False) -> None:
    """Copy a table with Spark tasks, so no file passes through the driver.

    JSON is copied line by line, CSV cell by cell, Parquet value by value: nothing is typed
    or replaced. A CSV record with more cells than its header, or a header that names a
    column twice, has no such copy and raises.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    fmt = table_format(source)
    if fmt == "json":
        spark.read.text(source, lineSep="\n").write.mode(mode).text(destination)
    elif fmt == "parquet":
        spark.read.parquet(source).write.mode(mode).parquet(destination)
    else:
        head = spark.read.csv(source, header=False, multiLine=multiline, **CSV).head()
        if head is not None and repeated_names(list(head)):
            raise ValueError(f"{source} repeats the columns {repeated_names(list(head))}")
        whole_csv(spark, source, multiline=multiline).write.mode(mode).csv(
            destination,
            header=True,
            quote='"',
            escape='"',
            emptyValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )


def ingest(spark, source: str, raw_dir: str, *, overwrite: bool = False, **reading):
    """Snapshot ``source`` into ``raw_dir`` and read it back.

    Returns (path, table). An existing snapshot is kept unless ``overwrite``; a
    table without rows is rejected.
    """
    source = str(source).rstrip("/")
    if not exists(spark, source):
        raise FileNotFoundError(f"no source at {source}")
    destination = f"{str(raw_dir).rstrip('/')}/{source.rpartition('/')[2]}"
    protect_outputs(spark, [destination], [source], overwrite)
    snapshot(
        spark, source, destination, overwrite=overwrite, multiline=reading.get("multiline", False)
    )
    table = read_table(spark, destination, **reading)
    if not table.columns or table.isEmpty():
        raise ValueError(f"{destination} holds no rows")
    return destination, table


def same_bytes(spark, source: str, copy: str, *, whole_bytes=WHOLE_BYTES):
    """(file, bytes, parts, sha256, same): every file of either side; ``same`` is false where
    sizes or SHA-256 differ or a side has no such file."""
    ours = file_digests(spark, copy, whole_bytes=whole_bytes)
    theirs = file_digests(spark, source, whole_bytes=whole_bytes).select(
        F.col("file").alias("own_file"), F.col("bytes").alias("own_bytes"), F.col("sha256").alias("own_sha256")
    )
    same = (F.col("bytes") == F.col("own_bytes")) & (F.col("sha256") == F.col("own_sha256"))
    return ours.join(theirs, F.col("file") == F.col("own_file"), "full").select(
        F.coalesce("file", "own_file").alias("file"),
        "bytes",
        "parts",
        "sha256",
        F.coalesce(same, F.lit(False)).alias("same"),
    )


def ingest_bytes(
    spark, source: str, raw_dir: str, *, overwrite: bool = False, whole_bytes=WHOLE_BYTES, **reading
):
    """Copy ``source`` byte for byte into ``raw_dir``, hold the copy against it and read it back.

    Returns (path, table). An existing copy is kept unless ``overwrite``; a copy that differs
    and a table without rows are errors.
    """
    destination = copy_bytes(spark, source, raw_dir, overwrite=overwrite, whole_bytes=whole_bytes)
    wrong = same_bytes(spark, source, destination, whole_bytes=whole_bytes).filter("NOT same")
    names = [r["file"] for r in wrong.limit(10).collect()]
    if names:
        raise OSError(f"the copy at {destination} differs in {names}")
    table = read_table(spark, destination, fmt=table_format(source), **reading)
    if not table.columns or table.isEmpty():
        raise ValueError(f"{destination} holds no rows")
    return destination, table

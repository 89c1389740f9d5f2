"""Paths on the session's file systems, through Spark's Hadoop client."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(str(path))
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark, path) -> str:
    """Absolute form of a path with its scheme, for comparing paths."""
    p, fs = _path(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def exists(spark, path) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def size_in_bytes(spark, path) -> int:
    p, fs = _path(spark, path)
    return fs.getContentSummary(p).getLength()


def write_json(spark, payload, path, overwrite=True) -> None:
    """A small JSON document (report, manifest), indented, in UTF-8."""
    p, fs = _path(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(json.dumps(json_safe(payload), indent=2).encode("utf-8")))
    finally:
        out.close()


def read_json(spark, path):
    rows = spark.read.text(str(path), wholetext=True).collect()
    if len(rows) != 1:
        raise ValueError(f"{path} is not one JSON document")
    return json.loads(rows[0][0])


def json_safe(value):
    """Tuples, sets, paths and dates as plain JSON values."""
    if isinstance(value, dict):
        return {str(k): json_safe(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [json_safe(v) for v in value]
    if isinstance(value, (set, frozenset)):
        return sorted(json_safe(v) for v in value)
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value)


def protect_outputs(spark, outputs, inputs=(), overwrite=False) -> None:
    """Fail before any work: outputs must differ from each other and from the
    inputs, and may exist only with ``overwrite``."""
    places = [qualified(spark, p) for p in outputs]
    twice = sorted({p for p in places if places.count(p) > 1})
    if twice:
        raise ValueError(f"several outputs share a path: {twice}")
    shared = sorted(set(places) & {qualified(spark, p) for p in inputs})
    if shared:
        raise ValueError(f"an output would replace an input: {shared}")
    if not overwrite:
        present = [p for p in places if exists(spark, p)]
        if present:
            raise FileExistsError(f"these outputs exist already: {present}")

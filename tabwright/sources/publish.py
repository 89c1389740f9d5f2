"""Several outputs made visible together.

Outputs are written beside their places. A small record of what goes where is the commit: a
run that dies before it leaves the old outputs as they were, one that dies after it is
finished by the next reader or writer of the record. Folders without a record are ignored.
"""

from __future__ import annotations

from tabwright.sources.files import _path, exists, read_json, write_json


def staged(path) -> str:
    """Where an output is written before it is published."""
    return f"{str(path).rstrip('/')}.next"


def record_path(anchor) -> str:
    return f"{str(anchor).rstrip('/')}.commit"


def remove(spark, path) -> None:
    place, fs = _path(spark, path)
    fs.delete(place, True)


def publish(spark, anchor, paths) -> None:
    """Move the staged form of every path into place; ``anchor`` names the commit record."""
    paths = [str(p).rstrip("/") for p in paths]
    absent = [p for p in paths if not exists(spark, staged(p))]
    if absent:
        raise FileNotFoundError(f"nothing is staged for {absent}")
    write_json(spark, {"paths": paths}, record_path(anchor))
    finish(spark, anchor)


def finish(spark, anchor) -> None:
    """Complete a publication whose record is still there. Doing it twice changes nothing."""
    record = record_path(anchor)
    if not exists(spark, record):
        return
    for path in read_json(spark, record)["paths"]:
        source, fs = _path(spark, staged(path))
        if fs.exists(source):
            target, _ = _path(spark, path)
            fs.delete(target, True)
            if not fs.rename(source, target):
                raise OSError(f"could not publish {path}")
    remove(spark, record)


def clear(spark, paths) -> None:
    """Drop what an unfinished run has staged."""
    for path in paths:
        remove(spark, staged(path))

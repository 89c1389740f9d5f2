"""Byte-true copies of files, made by Spark tasks.

A file up to ``whole_bytes`` is one row of Spark's binary source and becomes one file of the
same name. A larger file of lines is read as ranges, one part for each range that a task
reads: a folder of the file's name with numbered parts, whose bytes in order of their names
are the file. Nothing but names, sizes and a file's first and last bytes passes through the
driver.

Spark's text writer adds a separator to every row. So that no byte is added, each row goes
without its last byte, and that byte is the separator of the job that writes it.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import scratch_path, small_table
from tabwright.sources.files import _path, protect_outputs, qualified

WHOLE_BYTES = 128 << 20
#: Spark decompresses these when it reads lines, so they are always copied whole.
PACKED = re.compile(r"\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zstd|xz|parquet|orc|avro)$", re.I)
BOM = b"\xef\xbb\xbf"
DIGESTS = "file string, bytes long, parts int, sha256 string"


@dataclass(frozen=True)
class FileEntry:
    name: str  # below the source folder
    path: str
    key: int  # hash of the path as Spark's metadata column writes it
    size: int


def list_files(spark, source) -> list[FileEntry]:
    """Name, path and size of every file below ``source`` (a file or a folder), by name.

    As in Spark's readers, names that start with ``_`` or ``.`` are left out.
    """
    place, fs = _path(spark, source)
    if not fs.exists(place):
        raise FileNotFoundError(f"no source at {source}")
    root = fs.makeQualified(place).toString().rstrip("/")
    found = []
    if fs.getFileStatus(place).isFile():
        found.append((root, fs.getFileStatus(place).getLen()))
        root = root.rpartition("/")[0]
    else:
        walk = fs.listFiles(place, True)
        while walk.hasNext():
            status = walk.next()
            found.append((status.getPath().toString(), status.getLen()))
    shown = [
        (p[len(root) + 1 :], p, n)
        for p, n in sorted(found)
        if not any(part[:1] in "_." for part in p[len(root) + 1 :].split("/"))
    ]
    full = [p for _, p, n in shown if n]
    keys = {}
    if full:
        seen = binary_files(spark, full).select("path", F.xxhash64("_metadata.file_path").alias("key"))
        keys = dict(map(tuple, seen.collect()))
        if len(set(keys.values())) != len(keys):
            raise ValueError(f"two files below {source} share a hash")
    return [FileEntry(name, p, keys.get(p, 0), n) for name, p, n in shown]


def binary_files(spark, paths) -> DataFrame:
    return spark.read.format("binaryFile").load([escaped(p) for p in paths])


def escaped(path: str) -> str:
    """A path whose characters are not taken as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def whole_rows(spark, files) -> DataFrame:
    """(key, part 0, body), one row per file."""
    return binary_files(spark, [f.path for f in files]).select(
        F.xxhash64("_metadata.file_path").alias("key"),
        F.lit(0).cast("long").alias("part"),
        F.col("content").alias("body"),
    )


def line_rows(spark, files) -> DataFrame:
    """(key, part, place, body): every line with its line feed, by range and place in it.

    ``part`` is where the range starts that a task reads. A byte order mark is not among the
    rows, and the last line has a line feed even if the file's has none.
    """
    lines = spark.read.option("lineSep", "\n").text([escaped(f.path) for f in files])
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("key"),
        F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("place"),
        F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("body"),
    )


def write_rows(rows: DataFrame, order, last_bytes, folder: str) -> None:
    """Write bodies one after the other, one file per key and part, nothing added.

    One job for each of ``last_bytes``, the bytes with which rows end.
    """
    body = F.expr("substring(body, 1, length(body) - 1)").cast("string")
    for last in last_bytes:
        (
            rows.filter(F.expr("substring(body, -1, 1)") == F.lit(bytes([last])))
            .sortWithinPartitions("key", "part", *order)
            .select(body.alias("value"), "key", "part")
            .write.partitionBy("key", "part")
            .option("lineSep", chr(last))
            .option("encoding", "ISO-8859-1")
            .mode("append")
            .text(folder)
        )


def move_parts(spark, folder: str) -> dict:
    """{(key, part): path} of what ``write_rows`` left in ``folder``."""
    place, fs = _path(spark, folder)
    found = {}
    if fs.exists(place):
        walk = fs.listFiles(place, True)
        while walk.hasNext():
            path = walk.next().getPath().toString()
            at = re.search(r"/key=(-?\d+)/part=(\d+)/part-[^/]*$", path)
            if at:
                slot = (int(at[1]), int(at[2]))
                if slot in found:
                    raise ValueError(f"two tasks wrote part {slot[1]} of one file")
                found[slot] = path
    return found


def edge_bytes(spark, path: str, size: int) -> tuple[bool, int]:
    """(starts with a byte order mark, last byte) of a file: two small reads."""
    place, fs = _path(spark, path)
    stream = fs.open(place)
    try:
        head = bytes(stream.read() & 255 for _ in range(min(3, size)))
        stream.seek(size - 1)
        return head == BOM, stream.read()
    finally:
        stream.close()


def copy_whole(spark, rows: DataFrame, folder: str) -> dict:
    ends = [r[0][0] for r in rows.select(F.expr("substring(body, -1, 1)")).distinct().collect()]
    write_rows(rows, (), sorted(ends), folder)
    return move_parts(spark, folder)


def copy_lines(spark, files, folder: str) -> dict:
    """Parts of large files; a missing last line feed and a byte order mark are set right after."""
    write_rows(line_rows(spark, files), ("place",), [10], folder)
    written = move_parts(spark, folder)
    mended = None
    for f in files:
        marked, last = edge_bytes(spark, f.path, f.size)
        own = sorted(p for k, p in written if k == f.key)
        for part in {own[0], own[-1]}:
            body = F.col("content")
            if part == own[-1] and last != 10:
                body = F.expr("substring(content, 1, length(content) - 1)")
            if part == own[0] and marked:
                body = F.concat(F.lit(BOM), body)
            elif part != own[-1] or last == 10:
                continue
            row = part_row(spark, written[f.key, part], f.key, part, body)
            mended = row if mended is None else mended.unionByName(row)
    if mended is not None:
        written |= copy_whole(spark, mended, f"{folder}-mended")
    return written


def part_row(spark, path, key, part, body) -> DataFrame:
    return binary_files(spark, [path]).select(
        F.lit(key).alias("key"), F.lit(part).cast("long").alias("part"), body.alias("body")
    )


def copy_bytes(spark, source, raw_dir, *, overwrite=False, whole_bytes=WHOLE_BYTES) -> str:
    """Copy a file, or all files below a folder, into ``raw_dir``; returns where it lies.

    An existing copy is kept unless ``overwrite``. The copy is written beside its place and
    moved there when it is whole, so a run that fails leaves the old copy.
    """
    source = str(source).rstrip("/")
    files = list_files(spark, source)
    destination = f"{str(raw_dir).rstrip('/')}/{source.rpartition('/')[2]}"
    protect_outputs(spark, [destination], [source], overwrite)
    large = [f for f in files if f.size > whole_bytes and not PACKED.search(f.name)]
    whole = [f for f in files if f.size and f not in large]
    if any(f.size >= 2**31 - 1 for f in whole):
        raise ValueError("a packed file of 2 GB or more cannot be one row")
    scratch = scratch_path(spark, "bytes")
    parts = copy_whole(spark, whole_rows(spark, whole), f"{scratch}/whole") if whole else {}
    if large:
        parts |= copy_lines(spark, large, f"{scratch}/lines")
    single = qualified(spark, files[0].path) == qualified(spark, source) if files else False
    ready = f"{destination}.copying"
    target, fs = _path(spark, ready)
    fs.delete(target, True)
    for f in files:
        place, _ = _path(spark, ready if single else f"{ready}/{f.name}")
        fs.mkdirs(place.getParent())
        own = sorted((part, path) for (key, part), path in parts.items() if key == f.key)
        if not f.size:
            fs.create(place, True).close()
        elif f in large:
            fs.mkdirs(place)
            for number, (_, path) in enumerate(own):
                move(fs, _path(spark, path)[0], _path(spark, f"{place.toString()}/{number:08d}")[0])
        else:
            move(fs, _path(spark, own[0][1])[0], place)
    final, _ = _path(spark, destination)
    fs.delete(final, True)
    move(fs, target, final)
    return destination


def move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"could not move {source.toString()} to {target.toString()}")


def file_digests(spark, path, *, whole_bytes=WHOLE_BYTES) -> DataFrame:
    """(file, bytes, parts, sha256) of every file below ``path``, a copy's parts taken as one.

    Files up to ``whole_bytes`` are hashed as one row in the JVM. Larger ones and parts are
    streamed in order through one task a file, which holds a batch of lines: the digest of a
    file cannot be put together from digests of its ranges.
    """
    files = list_files(spark, path)
    groups: dict[str, list[FileEntry]] = {}
    for f in files:
        folder, _, last = f.name.rpartition("/")
        groups.setdefault(folder if re.fullmatch(r"\d{8}", last) else f.name, []).append(f)
    if re.fullmatch(r"\d{8}", files[0].name if files else ""):  # the folder of one large file
        groups = {str(path).rstrip("/").rpartition("/")[2]: files}
    streamed, empty, plain = [], [], []
    for name, own in groups.items():
        if sum(f.size for f in own) == 0:
            empty.append((name, 0, len(own), hashlib.sha256().hexdigest()))
        elif len(own) > 1 or (own[0].size > whole_bytes and not PACKED.search(own[0].name)):
            marks = []
            for at, f in enumerate(own):
                marked, last = edge_bytes(spark, f.path, f.size)
                marks.append((f.key, name, at, len(own), marked, last == 10))
            streamed.append((own, marks))
        else:
            plain.append((own[0].key, name, own[0].path))
    out = small_table(spark, empty, DIGESTS)
    if plain:
        names = small_table(spark, [p[:2] for p in plain], "own long, file string")
        rows = binary_files(spark, [p[2] for p in plain]).select(
            F.xxhash64("_metadata.file_path").alias("key"),
            F.col("length").alias("bytes"),
            F.sha2("content", 256).alias("sha256"),
        )
        out = out.unionByName(
            rows.join(names, F.col("key") == F.col("own")).select(
                "file", "bytes", F.lit(1).alias("parts"), "sha256"
            )
        )
    if streamed:
        out = out.unionByName(streamed_digests(spark, streamed))
    return out


def streamed_digests(spark, groups) -> DataFrame:
    marks = small_table(
        spark,
        [m for _, marks in groups for m in marks],
        "own long, file string, number int, parts int, marked boolean, ended boolean",
    )
    lines = spark.read.option("lineSep", "\n").text([escaped(f.path) for own, _ in groups for f in own])
    rows = lines.select(
        F.xxhash64("_metadata.file_path").alias("key"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").cast("binary").alias("body"),
    )
    rows = rows.join(marks, F.col("key") == F.col("own")).select(
        "file", "parts", "number", "start", "place", "marked", "ended", "body"
    )

    def run(batches):
        import pyarrow as pa

        name = number = ended = total = None
        size = parts = 0

        def closed():
            if ended:
                take(b"\n")
            columns = [[name], [size], pa.array([parts], pa.int32()), [total.hexdigest()]]
            return pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                names=["file", "bytes", "parts", "sha256"],
            )

        def take(body):
            nonlocal size
            total.update(body)
            size += len(body)

        for batch in batches:
            for row in batch.to_pylist():
                if total is None or row["file"] != name:
                    if total is not None:
                        yield closed()
                    name, parts, number = row["file"], row["parts"], None
                    total, size = hashlib.sha256(), 0
                if number is not None and (row["number"] == number or ended):
                    take(b"\n")  # of the line before; the last of a part may have none
                if row["number"] != number and row["marked"]:
                    take(BOM)
                take(row["body"])
                number, ended = row["number"], row["ended"]
        if total is not None:
            yield closed()

    return (
        rows.repartition("file")
        .sortWithinPartitions("file", "number", "start", "place")
        .mapInArrow(run, DIGESTS)
    )


def first_and_later_parts(spark, path) -> tuple[list[str], list[str]]:
    """Paths of a table whose files begin with a header, and of those that do not.

    The latter are the later parts of large files copied as ranges, either ``path`` itself or
    files in it. Any other path is returned as it is.
    """
    place, fs = _path(spark, path)
    if "*" in str(path) or not fs.exists(place) or fs.getFileStatus(place).isFile():
        return [str(path)], []
    own = numbered_parts(fs, place)
    if own:
        return own[:1], own[1:]
    first, later = [], []
    for status in fs.listStatus(place):
        child = status.getPath()
        parts = numbered_parts(fs, child) if status.isDirectory() else []
        later += parts[1:]
        if parts or (status.isFile() and child.getName()[0] not in "_."):
            first.append((parts or [child.toString()])[0])
    return (sorted(first), later) if any(re.search(r"/\d{8}$", p) for p in first) else ([str(path)], [])


def numbered_parts(fs, place) -> list[str]:
    found = sorted(s.getPath().toString() for s in fs.listStatus(place) if s.isFile())
    names = [p.rpartition("/")[2] for p in found]
    return found if names and names == [f"{i:08d}" for i in range(len(names))] else []

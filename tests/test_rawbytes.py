import hashlib
import os

import pytest

from tabwright.sources import rawbytes
from tabwright.sources.tables import raw_csv, read_table
from tabwright.sources.zones import ingest_bytes, same_bytes

FILES = {
    "a.csv": b"\xef\xbb\xbfid,name\r\n1,x,extra\r\nid,name\r\n2\r\n\r\n3,\"q,\"\r\n",
    "b.csv": b"id,name\n1,\"two\nlines\"\nlast,\xe9\xff",  # no line feed at the end, bytes that are no UTF-8
    "c d=50%[x]*.csv": b"id\n" + b"".join(b"%d\n" % i for i in range(500)),
    "deep/e.bin": bytes(range(256)) * 40,
    "deep/one line": b"x" * 3000,
    "deep/feeds": b"\n" * 100,
    "marked": b"\xef\xbb\xbf" + b"y" * 900,
    "empty.csv": b"",
    "_hidden": b"no",
}


def write_files(folder, files):
    for name, body in files.items():
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "wb") as f:
            f.write(body)


def content(path):
    """Bytes of a copy, its parts in order of their names."""
    if os.path.isfile(path):
        with open(path, "rb") as f:
            return f.read()
    return b"".join(content(f"{path}/{p}") for p in sorted(os.listdir(path)) if p[0] not in "_.")


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("whole_bytes", [rawbytes.WHOLE_BYTES, 200, 0])
def test_copies_are_byte_true(spark, tmp_path, small_ranges, whole_bytes):
    source, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    write_files(source, FILES)
    place = rawbytes.copy_bytes(spark, source, raw, whole_bytes=whole_bytes)
    shown = {n: b for n, b in FILES.items() if n != "_hidden"}
    for name, body in shown.items():
        assert content(f"{place}/{name}") == body, name
    assert not os.path.exists(f"{place}/_hidden")
    digests = {r.file: r for r in rawbytes.file_digests(spark, place, whole_bytes=whole_bytes).collect()}
    assert set(digests) == set(shown)
    for name, body in shown.items():
        assert (digests[name].bytes, digests[name].sha256) == (len(body), hashlib.sha256(body).hexdigest())
    if whole_bytes == 0:
        assert digests["deep/e.bin"].parts > 5
        assert os.path.isdir(f"{place}/deep/e.bin")
    found = same_bytes(spark, source, place, whole_bytes=whole_bytes).collect()
    assert len(found) == len(shown) and all(r.same for r in found)
    with open(f"{source}/marked", "ab") as f:
        f.write(b"z")
    write_files(source, {"new": b"1"})
    found = {r.file: r.same for r in same_bytes(spark, source, place).collect()}
    assert not found["marked"] and not found["new"] and found["a.csv"]


def test_one_file_and_overwrite(spark, tmp_path):
    write_files(tmp_path, {"in/t.csv": b"a,b\r\n1,2\r\n"})
    source, raw = str(tmp_path / "in" / "t.csv"), str(tmp_path / "raw")
    path, table = ingest_bytes(spark, source, raw)
    assert content(path) == b"a,b\r\n1,2\r\n" and os.path.isfile(path)
    assert [tuple(r) for r in table.collect()] == [(1, 2)]
    with pytest.raises(FileExistsError):
        ingest_bytes(spark, source, raw)
    write_files(tmp_path, {"in/t.csv": b"a\n7"})
    assert ingest_bytes(spark, source, raw, overwrite=True)[1].first()["a"] == 7
    assert content(path) == b"a\n7"
    write_files(tmp_path, {"in/none.csv": b"a,b\n", "in/void.csv": b""})
    for name in ("none.csv", "void.csv"):
        with pytest.raises(ValueError):
            ingest_bytes(spark, str(tmp_path / "in" / name), raw)
    with pytest.raises(FileNotFoundError):
        ingest_bytes(spark, str(tmp_path / "in" / "no.csv"), raw)


def test_a_large_csv_is_read_from_its_parts(spark, tmp_path, small_ranges):
    body = b"id,name\r\n" + b"".join(b"%d,n%d\r\n" % (i, i) for i in range(900)) + b"id,name"
    write_files(tmp_path, {"in/t.csv": body})
    source, raw = str(tmp_path / "in" / "t.csv"), str(tmp_path / "raw")
    path, table = ingest_bytes(spark, source, raw, whole_bytes=1000)
    assert len(os.listdir(path)) > 5 and content(path) == body
    rows = [tuple(r) for r in table.collect()]
    # the repeated header at the end is data, as it is in the source
    assert sorted(rows) == sorted([(str(i), f"n{i}") for i in range(900)] + [("id", "name")])
    assert read_table(spark, source).count() == 901
    assert raw_csv(spark, path).filter("id = '0'").count() == 1

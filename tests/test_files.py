"""File digests, and rescans that read only what changed."""

import hashlib
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from factline.sources import files

MARK = b"\xef\xbb\xbf"


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(3)
    contents = [b"\n", b"a", b"a\n", b"\n\n", b"a\r\nb\rc\n", MARK, MARK + b"\n", MARK + b"x\ny", MARK + b"x\ny\n", MARK + MARK + b"q",
                rng.randbytes(100_000), b"\n" * 1000, rng.randbytes(5000) + b"\n", b"\xff\xfe\x00"]
    for i, content in enumerate(contents):
        (tmp_path / f"f {i}+[1]%20é.bin").write_bytes(content)
    return tmp_path


def digests(df):
    return {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in df.collect()}


@pytest.mark.parametrize("cell", [files.CELL_BYTES, 50, 0])
@pytest.mark.parametrize("split", ["128m", "997"])
def test_long_files_have_the_hash_of_their_bytes(spark, folder, cell, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = digests(files.file_digests(spark, str(folder), cell_bytes=cell))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in folder.iterdir()}


def test_only_what_changed_is_read_again(spark, tmp_path):
    for name in ("same", "edited", "touched", "gone"):
        (tmp_path / f"{name}.txt").write_text(name)
    (tmp_path / "nested").mkdir()
    (tmp_path / "nested" / "same [2].txt").write_text("deep")
    known = spark.createDataFrame(files.file_digests(spark, str(tmp_path)).withColumn("sha256", F.concat(F.lit("known-"), "sha256")).collect(),
                                  "path string, length bigint, modified timestamp, sha256 string")
    (tmp_path / "edited.txt").write_text("EDITED")
    os.utime(tmp_path / "edited.txt", (5, 5))
    os.utime(tmp_path / "touched.txt", (7, 7))
    (tmp_path / "gone.txt").unlink()
    (tmp_path / "added.txt").write_text("added")
    found = {r["path"].rsplit("/", 1)[1]: r for r in files.rescan(spark, known, files.list_files(spark, str(tmp_path))).collect()}
    # What was known is wrong on purpose: it stays only where the file was not read.
    assert {n: (r["status"], r["sha256"].startswith("known-")) for n, r in found.items()} == {
        "same.txt": ("unchanged", True), "same [2].txt": ("unchanged", True), "gone.txt": ("gone", True),
        "edited.txt": ("changed", False), "touched.txt": ("changed", False), "added.txt": ("added", False)}
    assert found["edited.txt"]["sha256"] == hashlib.sha256(b"EDITED").hexdigest() and found["edited.txt"]["length"] == 6
    true = files.file_digests(spark, str(tmp_path))
    os.utime(tmp_path / "touched.txt", (9, 9))
    kept = spark.createDataFrame(true.collect(), true.schema)
    os.utime(tmp_path / "touched.txt", (11, 11))
    again = files.rescan(spark, kept, files.list_files(spark, str(tmp_path)))
    assert rows(again.groupBy("status").count()) == [("touched", 1), ("unchanged", 4)]


def test_one_csv_file_for_each_value(spark, tmp_path, monkeypatch):
    """The bytes are those of Spark's writer; folders are few however many files there are."""
    odd = [('a"b', 1.0, None), ("x,y\nz", 2.5, "é"), ("", float("nan"), ""), (None, None, " s "), ("\\", 1e20, 'q\\"')]
    made = [(k, n, *odd[(k + n) % 5]) for k in range(-3, 120) for n in range(6)] + [(500, n, *odd[n % 5]) for n in range(25_000)] + [(None, 0, *odd[0])]
    rows_ = spark.createDataFrame(made, "by bigint, n int, item string, value double, category string").repartition(7)

    def written(name):
        files.write_csv_each(rows_, "by", ["n"], ["item", "value", "category"], f"{tmp_path}/{name}")
        found = files._files(spark, f"{tmp_path}/{name}", "*.csv").select(F.regexp_extract("path", "by=([^/.]*)", 1), "content").collect()
        return [(r[0], bytes(r[1])) for r in found]

    got = written("here é%20")
    assert len(list((tmp_path / "here é%20").rglob("*"))) <= len(got) + files.FOLDERS
    monkeypatch.setattr(files, "_local_folder", lambda spark, path: None)
    assert len(got) == 125 and sorted(got) == sorted(written("there"))


def test_folders_of_the_file_system(spark):
    got = [files._local_folder(spark, p) for p in ("/a b/%20", "file:/a b", "file:///a#b", "s3a://bucket/a", "hdfs://host:1/a")]
    assert got == ["/a b/%20", "/a b", "/a#b", None, None]

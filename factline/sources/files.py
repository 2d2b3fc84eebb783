"""Files as assets and as tables."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factline.functions import text
from factline.functions.canonical import canonical_row
from factline.operators.delimited import BLOCK_LINES
from factline.storage import keep

#: Folders that small files are spread over: enough for Spark to list them in tasks, whatever the number of files.
FOLDERS = 64
#: What Spark's writers call the folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Files of up to this length are hashed as one value.
CELL_BYTES = 64 << 20
MARK = b"\xef\xbb\xbf"


def asset_id(path: Column, sha256: Column) -> Column:
    """A repeatable id from the path and the content hash."""
    return F.sha2(F.concat(path, F.lit("\n"), sha256), 256)


def _files(spark: SparkSession, path: str | list[str], glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Path, length and time of the files under a folder; no bytes are read."""
    return _files(spark, path, glob).select("path", "length", F.col("modificationTime").alias("modified"))


def file_digests(spark: SparkSession, path: str | list[str], glob: str | None = None, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """Path, length, time and SHA-256 of every file, whatever its size.

    A file of up to `cell_bytes` is hashed as one value where it is read. A longer one is read
    in Spark's blocks, cut at line feeds, and its pieces stream in order through one hash: no
    task holds more of it than a batch of pieces. Both give the hash of the same bytes. The
    paths of long files pass through the driver, which lists them for Spark anyway.
    """
    found = _files(spark, path, glob)
    short = found.filter(F.col("length") <= cell_bytes).select(
        "path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))
    long = found.filter(F.col("length") > cell_bytes).select("path", "length", F.col("modificationTime").alias("modified"))
    paths = [r["path"] for r in long.select("path").collect()]
    if not paths:
        return short
    streamed = long.join(_streamed_digests(spark, paths), "path", "left")
    # Only a byte order mark alone has no pieces.
    return short.unionByName(streamed.withColumn("sha256", F.coalesce("sha256", F.lit(hashlib.sha256(MARK).hexdigest()))))


def _streamed_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """`(path, sha256)` of files, each piece of which is a row between two line feeds."""
    pieces = spark.read.option("lineSep", "\n").text([_escaped(p) for p in paths]).select(
        plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("piece"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.repartition(parts, "path").sortWithinPartitions("path", "block", "at").select("path", "size", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, size, seen, plain, marked = None, 0, 0, None, None

        def ended() -> pa.RecordBatch:
            # The reader takes a byte order mark away, and does not tell whether a line feed ends the file.
            missing = size - seen
            digest = marked if missing >= len(MARK) else plain
            if missing % len(MARK):
                digest.update(b"\n")
            return pa.record_batch([[current], [digest.hexdigest()]], ["path", "sha256"])

        for batch in batches:
            names = batch.column("path").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for start, stop in zip(cuts[:-1], cuts[1:]):
                if start == stop:
                    continue
                part = b"\n".join(batch.column("piece").slice(start, stop - start).to_pylist())
                if names[start] != current:
                    if current is not None:
                        yield ended()
                    current, size, seen = names[start], batch.column("size")[start].as_py(), len(part)
                    plain, marked = hashlib.sha256(part), hashlib.sha256(MARK + part)
                else:
                    seen += len(part) + 1
                    for digest in (plain, marked):
                        digest.update(b"\n")
                        digest.update(part)
        if current is not None:
            yield ended()

    return ordered.mapInArrow(run, "path string, sha256 string")


def plain_path(path: Column) -> Column:
    """A path as files name it, from the percent-encoded form of `_metadata`, where a plus stands for itself."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _escaped(path: str) -> str:
    """A path that holds no patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def rescan(spark: SparkSession, known: DataFrame, listed: DataFrame) -> DataFrame:
    """Files as listed now against `(path, length, modified, sha256)` of an earlier scan.

    Columns: those of `file_digests` now, and `status`: unchanged, changed, touched (time or
    length differ, bytes do not), added, or gone (with what was known of it). Only files whose
    length or time differ are read.
    """
    before = known.select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"), F.col("sha256").alias("_sha256"))
    met = keep(listed.join(before, "path", "full_outer"), "rescan")
    same = F.coalesce((F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified")), F.lit(False))
    old = met.filter(same).select("path", "length", "modified", F.col("_sha256").alias("sha256"), F.lit("unchanged").alias("status"))
    gone = met.filter(F.col("length").isNull()).select(
        "path", F.col("_length").alias("length"), F.col("_modified").alias("modified"), F.col("_sha256").alias("sha256"), F.lit("gone").alias("status"))
    settled = old.unionByName(gone)
    stale = met.filter(~same & F.col("length").isNotNull()).select("path", "_sha256")
    paths = [_escaped(r["path"]) for r in stale.select("path").collect()]  # a part of the list that Spark's driver holds
    if not paths:
        return settled
    status = F.when(F.col("_sha256").isNull(), "added").when(F.col("_sha256") == F.col("sha256"), "touched").otherwise("changed")
    fresh = file_digests(spark, paths).join(stale, "path").select("path", "length", "modified", "sha256", status.alias("status"))
    return settled.unionByName(fresh)


def as_assets(digests: DataFrame) -> DataFrame:
    """Registry rows of files with digests; a `content` column stays."""
    return digests.select(
        asset_id(F.col("path"), F.col("sha256")).alias("asset_id"), "path",
        text.media_type(F.col("path")).alias("media_type"), "sha256",
        text.file_name(F.col("path")).alias("original_name"), "length", *[c for c in ("modified", "content") if c in digests.columns])


def scan_assets(spark: SparkSession, path: str, glob: str | None = None, content: bool = False) -> DataFrame:
    """One registry row for every file. With `content` the bytes are a cell, so each file has to fit in one."""
    if not content:
        return as_assets(file_digests(spark, path, glob).drop("modified"))
    return as_assets(_files(spark, path, glob).select("path", "length", "content", F.sha2("content", 256).alias("sha256")))


def csv_lines(spark: SparkSession, path: str, glob: str | None = None, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Lines `(asset_id, block, at, line)` of text files, cut where Spark cuts them; the id is the file's path.

    `block` is where a file's part starts and which `block_lines` lines of its task it holds, `at` the order of lines in it.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    found = (reader.option("pathGlobFilter", glob) if glob else reader).text(path)
    read = found.select(plain_path(F.col("_metadata.file_path")).alias("asset_id"), F.col("_metadata.file_block_start").alias("start"),
                        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    return read.select("asset_id", F.struct("start", F.floor(F.col("at") / block_lines).alias("part")).alias("block"), "at", "line")


def oversized_files(spark: SparkSession, path: str, max_bytes: int, glob: str | None = None) -> DataFrame:
    """Files over a size that the caller sets, as violations; their bytes are never read."""
    return _files(spark, path, glob).filter(F.col("length") > max_bytes).select("path", "length")


def total_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Number and total size of the files under a folder, without reading their bytes."""
    return _files(spark, path, None).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def load_table(spark: SparkSession, path: str, kind: str | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """Read CSV (with a header), Parquet or JSON lines.

    Give a schema for large CSV and JSON input; without one the file is read twice, and
    whole numbers come out as bigint.
    """
    kind = kind or {"csv": "csv", "parquet": "parquet", "jsonl": "json", "json": "json"}.get(path.rstrip("/").rsplit(".", 1)[-1])
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind not in ("csv", "json"):
        raise ValueError(f"no table reader for {path}")
    reader = spark.read.schema(schema) if schema else spark.read
    if kind == "json":
        return reader.json(path)
    table = reader.csv(path, header=True, inferSchema=schema is None)
    if schema is None:
        return table.select(*[
            F.col(f"`{f.name}`").cast("bigint").alias(f.name) if isinstance(f.dataType, T.IntegerType) else F.col(f"`{f.name}`")
            for f in table.schema.fields])
    return table


def write_jsonl(df: DataFrame, path: str) -> None:
    """Rows as canonical JSON lines: sorted keys, nulls kept, hex bytes, other types as text."""
    df.select(canonical_row(df.schema).alias("value")).write.text(path)


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system names it; null where it lies in another kind of store."""
    scheme = re.match("([a-zA-Z][^:/]*):", path) or re.match("([a-zA-Z][^:/]*):", spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "")
    return os.path.abspath(re.sub("^file:(?://[^/]*)?", "", path)) if scheme is None or scheme[1] == "file" else None


def write_csv_each(rows: DataFrame, by: str, order: list[str], columns: list[str], path: str) -> None:
    """One CSV file with a header for each value of `by`, its rows in order; the path of a file holds `<by>=<value>`.

    Rows are sorted and formatted by Spark. For a folder of the file system, tasks write the
    files themselves: Spark's writer starts two processes for each file there, to set its mode
    and that of its checksum, and makes a folder for each, which is then listed by a task of its
    own. Files are many to a folder here. Other stores get Spark's writer.
    """
    spark = rows.sparkSession
    ordered = rows.repartition(by).sortWithinPartitions(by, *order)
    folder = _local_folder(spark, path)
    if folder is None:
        ordered.select(*columns, by).write.partitionBy(by).option("header", "true").option("escape", '"').csv(path)
        return
    head = (",".join(columns) + "\n").encode()
    name = F.concat(
        F.pmod(F.xxhash64(by), F.lit(FOLDERS)).cast("string"), F.lit(f"/{by}="), F.coalesce(F.col(by).cast("string"), F.lit(NO_VALUE)), F.lit(".csv"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, file, hidden, made = None, None, None, 0

        def ended() -> None:
            file.close()
            os.replace(hidden, f"{folder}/{current}")  # whole at once, also if a task is tried again

        for batch in batches:
            runs = pc.run_end_encode(batch.column("name"))
            stops = runs.run_ends.to_pylist()
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, *stops], pa.int32()), batch.column("line")), "\n")
            for found, text_ in zip(runs.values.to_pylist(), texts):
                if found != current:
                    if current is not None:
                        ended()
                    current, hidden, made = found, f"{folder}/{os.path.dirname(found)}/.{uuid4().hex}", made + 1
                    os.makedirs(os.path.dirname(hidden), exist_ok=True)
                    file = open(hidden, "wb")
                    file.write(head)
                file.write(text_.as_buffer())
                file.write(b"\n")
        if current is not None:
            ended()
        yield pa.record_batch([[made]], ["files"])

    lines = ordered.select(name.alias("name"), F.to_csv(F.struct(*columns), {"escape": '"'}).alias("line"))
    os.makedirs(folder, exist_ok=True)
    lines.mapInArrow(run, "files bigint").write.format("noop").mode("overwrite").save()

"""Published artifacts: immutable table folders with hashes and a manifest written last.

Layout under a store's root:

    data/<artifact_id>/outputs/<name>/     Parquet part files
    data/<artifact_id>/files/              one row per part file: path, length, sha256
    manifests/folder=<artifact_id>/        the manifest text

A folder without a manifest is not an artifact, so a run that fails part-way publishes
nothing. This needs no rename and therefore also holds on object stores.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factline.functions.canonical import canonical
from factline.operators.checks import ContractError, check_images, check_manifests, fixed_schema, require_none, verify_files
from factline.operators.versions import content_digest, table_digest
from factline.sources import files

SCHEMA_VERSION = "evidence-artifact/v1"
FILE_SCHEMA = "path string, length bigint, sha256 string"


def now() -> str:
    return f"{datetime.now(timezone.utc):%Y-%m-%dT%H:%M:%S.%fZ}"


def hash_files(spark: SparkSession, folder: str, below: str = "outputs") -> DataFrame:
    """Path relative to `folder`, length and SHA-256 of every Parquet part file."""
    name = folder.rstrip("/").rsplit("/", 1)[-1]
    found = files.file_digests(spark, f"{folder}/{below}", "*.parquet")
    return found.select(F.substring_index("path", f"/{name}/", -1).alias("path"), "length", "sha256")


def folder_digest(spark: SparkSession, folder: str) -> str:
    """Digest of every file below a folder: relative path and hash, in any order."""
    name = folder.rstrip("/").rsplit("/", 1)[-1]
    found = files.file_digests(spark, folder)
    return table_digest(found.select(F.substring_index("path", f"/{name}/", -1).alias("path"), "sha256"))[1]


def verify_tables(spark: SparkSession, folder: str, entries: list[dict]) -> None:
    """Compare the file list and every part file."""
    listed = spark.read.schema(FILE_SCHEMA).parquet(f"{folder}/files")
    digests = _list_digests(listed)
    for entry in entries:
        if digests.get(entry["path"]) != entry["sha256"]:
            raise ContractError(f"hash mismatch: file list of {entry['name']}")
    bad = verify_files(*[df.select("path", "sha256") for df in (listed, hash_files(spark, folder))]).filter(F.col("status") != "ok").take(1)
    if bad:
        raise ContractError(f"hash mismatch: {bad[0]['path']} is {bad[0]['status']}")


def write_tables(spark: SparkSession, tables: dict[str, DataFrame], folder: str, max_records_per_file: int) -> list[dict]:
    """Write each table, then the list of part-file hashes; give one entry per table."""
    entries = []
    for name, df in tables.items():
        path = f"{folder}/outputs/{name}"
        df.write.option("maxRecordsPerFile", max_records_per_file).parquet(path)
        stored = spark.read.schema(df.schema).parquet(path)
        rows, digest = table_digest(stored)
        kind = {"documents": "document", "evidence": "evidence", "image_bytes": "image"}.get(name, "table")
        entries.append({"name": name, "kind": kind, "format": "parquet", "path": f"outputs/{name}",
                        "rows": rows, "content_digest": digest, "schema": json.loads(df.schema.json())})
    hash_files(spark, folder).write.parquet(f"{folder}/files")
    listed = spark.read.schema(FILE_SCHEMA).parquet(f"{folder}/files")
    # A table is one folder of part files; its hash is the digest of their listed hashes.
    digests = _list_digests(listed)
    for entry in entries:
        entry["sha256"] = digests[entry["path"]]
    return entries


def _list_digests(listed: DataFrame) -> dict[str, str]:
    """For each table folder the digest of its file list."""
    return {r["group"]: r["digest"] for r in content_digest(listed, F.substring_index("path", "/", 2)).collect()}


def _write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)


def publish(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    root: str,
    scope: str,
    recipe: dict,
    recipe_hash: str,
    package: dict,
    sources: list[dict] | None = None,
    max_records_per_file: int = 5_000_000,
    check: Callable[[dict[str, DataFrame]], None] | None = None,
) -> dict:
    """Write the tables, check the fixed contracts and the bytes of images, and commit by writing the manifest.

    `check` gets the written tables before the commit; when it raises, nothing is published.
    """
    for name, df in tables.items():
        problems = fixed_schema(df.schema, name)
        if problems:
            raise ContractError(f"{name}: {problems}")
    artifact_id = str(uuid4())
    folder = f"{root}/data/{artifact_id}"
    outputs = write_tables(spark, tables, folder, max_records_per_file)
    manifest = {"schema_version": SCHEMA_VERSION, "artifact_id": artifact_id, "scope_id": scope, "created_at": now(),
                "recipe_hash": recipe_hash, "recipe": recipe, "package": package, "sources": sources or [], "outputs": outputs}
    written = tables_of(spark, root, manifest) if check is not None or {"images", "image_bytes"} <= tables.keys() else {}
    if {"images", "image_bytes"} <= tables.keys():
        held = written["image_bytes"].select(F.col("original_ref").alias("path"), "content")
        require_none(check_images(written["images"].withColumn("path", F.col("original_ref")), held), "images")
    if check is not None:
        check(written)
    row = check_manifests(
        spark.createDataFrame([(artifact_id, canonical(manifest))], "folder string, text string"), scope, SCHEMA_VERSION).first()
    if row["status"] != "ok":
        raise ContractError(f"manifest: {row['status']}")
    _write_text(spark, canonical(manifest), f"{root}/manifests/folder={artifact_id}")
    return manifest


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """Every committed manifest as `(folder, text)`; empty when nothing is published."""
    try:
        found = spark.read.option("wholetext", "false").option("basePath", f"{root}/manifests").text(f"{root}/manifests")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "folder string, text string")
    return found.select(F.col("folder").cast("string").alias("folder"), F.col("value").alias("text"))


def index(spark: SparkSession, root: str) -> DataFrame:
    """Recipe hash, creation time and output digests of every committed artifact."""
    m = F.from_json("text", "artifact_id string, scope_id string, created_at string, recipe_hash string, "
                            "outputs array<struct<name:string,content_digest:string>>")
    return manifests(spark, root).select(m.alias("m")).select(
        "m.artifact_id", "m.scope_id", "m.created_at", "m.recipe_hash",
        F.to_json("m.outputs").alias("content_digest"))


def find(spark: SparkSession, root: str, recipe_hash: str) -> str | None:
    """The earliest committed artifact of a recipe."""
    row = (index(spark, root).filter(F.col("recipe_hash") == recipe_hash)
           .orderBy("created_at", "artifact_id").select("artifact_id").head())
    return row["artifact_id"] if row else None


def verify(spark: SparkSession, root: str, artifact_id: str, scope: str) -> dict:
    """The manifest, after its rules, its file list and every part file have been checked."""
    found = manifests(spark, root).filter(F.col("folder") == artifact_id)
    row = check_manifests(found, scope, SCHEMA_VERSION).first()
    if row is None:
        raise ContractError("artifact not found")
    if row["status"] != "ok":
        raise ContractError(f"manifest: {row['status']}")
    manifest = json.loads(found.first()["text"])
    verify_tables(spark, f"{root}/data/{artifact_id}", manifest["outputs"])
    return manifest


def load(spark: SparkSession, root: str, artifact_id: str, scope: str) -> dict[str, DataFrame]:
    """The verified artifact's tables. Image rows point at their bytes inside the artifact."""
    return tables_of(spark, root, verify(spark, root, artifact_id, scope))


def tables_of(spark: SparkSession, root: str, manifest: dict) -> dict[str, DataFrame]:
    """The tables of a manifest that was just verified or just written."""
    folder = f"{root}/data/{manifest['artifact_id']}"
    tables = {
        o["name"]: spark.read.schema(T.StructType.fromJson(o["schema"])).parquet(f"{folder}/{o['path']}")
        for o in manifest["outputs"] if o["format"] == "parquet"
    }
    if "images" in tables:
        if "image_bytes" not in tables:
            raise ContractError("images have no byte mapping")
        held = tables["image_bytes"].select("original_ref", F.lit(True).alias("_held"))
        images = tables["images"].join(held, "original_ref", "left")
        if images.filter(F.col("_held").isNull()).take(1):
            raise ContractError("an image has no byte mapping")
        here = F.concat(F.lit(f"{folder}/outputs/image_bytes#"), F.col("original_ref"))
        tables["images"] = images.select("original_ref", here.alias("path"), "mime_type")
    return tables


def image_outputs(images: DataFrame, held: DataFrame) -> dict[str, DataFrame]:
    """The images table and its bytes `(path, content)` keyed by `original_ref`, ready to publish."""
    found = images.join(held.select("path", "content"), "path", "left")
    require_none(found.filter(F.col("content").isNull()).select("original_ref", "path"), "images without bytes")
    stored = found.select("original_ref", "mime_type", "content", F.sha2("content", 256).alias("sha256"))
    return {"images": images.select("original_ref", "path", "mime_type"), "image_bytes": stored}

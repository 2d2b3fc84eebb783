"""Checkpoints of chosen tables, and their verified restoration.

A checkpoint may continue an earlier one: rows are dealt to buckets by hash, and a bucket whose digest is
that of the earlier checkpoint is not written again but named where it lies. Checkpoints that others
continue have to be kept.
"""

from __future__ import annotations

import json
from uuid import uuid4

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factline.functions.canonical import canonical, digest_text
from factline.operators.checks import ContractError
from factline.operators.versions import code_digest, content_digest, table_digest
from factline.sources import artifacts

CHECKPOINT_VERSION = "evidence-checkpoint/v1"
# The table of saved input files, with their bytes.
ASSETS = "input_file_copies"


# Of each bucket its rows, their digest, and the checkpoint that holds them.
BUCKETS = "bucket bigint, rows bigint, digest string, held_by string"


def save(spark: SparkSession, tables: dict[str, DataFrame], root: str, scope: str,
         provenance: dict[str, dict] | None = None, assets: DataFrame | None = None) -> str:
    """Write the chosen tables (and asset rows with their bytes); the manifest is written last."""
    checkpoint_id = str(uuid4())
    folder = f"{root}/checkpoints/data/{checkpoint_id}"
    chosen = dict(tables)
    if assets is not None:
        chosen[ASSETS] = assets
    entries = artifacts.write_tables(spark, chosen, folder, 5_000_000)
    for entry in entries:
        entry["provenance"] = (provenance or {}).get(entry["name"], {})
    return _commit(spark, root, checkpoint_id, scope, entries)


def _commit(spark: SparkSession, root: str, checkpoint_id: str, scope: str, entries: list[dict]) -> str:
    text = canonical({"schema_version": CHECKPOINT_VERSION, "checkpoint_id": checkpoint_id, "scope_id": scope,
                      "created_at": artifacts.now(), "spark_version": pyspark.__version__, "tables": entries})
    artifacts._write_text(spark, text + "\n" + code_digest(text), f"{root}/checkpoints/manifests/folder={checkpoint_id}")
    return checkpoint_id


def _unused(name: str, columns: list[str]) -> str:
    """The name, lengthened until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def save_changed(spark: SparkSession, tables: dict[str, DataFrame], root: str, scope: str, after: str | None = None,
                 keys: dict[str, list[str]] | None = None, buckets: int = 256, provenance: dict[str, dict] | None = None) -> str:
    """Write those buckets of the tables that differ from the checkpoint `after`; the manifest is written last.

    A row's bucket comes from its key columns where `keys` names them, else from the whole row, so a changed
    row rewrites one bucket or two. The table's digest is compared first, then those of its buckets; each is
    a count and two sums per bucket, combined before the shuffle. A table with another schema, key or number
    of buckets is written whole, and so is one that `after` saved by `save`. A bucket is written by as many
    tasks as its size asks for (a rebalance, not one task a bucket), so repeated rows and hot keys spread.
    The tables are computed twice (digests, then changed buckets): give stored tables, as those of a workspace are.
    """
    checkpoint_id = str(uuid4())
    folder = f"{root}/checkpoints/data/{checkpoint_id}"
    old = {e["name"]: e for e in _manifest(spark, root, after, scope)["tables"]} if after else {}
    entries = []
    for name, df in tables.items():
        by = (keys or {}).get(name) or df.columns
        gone = set(by) - set(df.columns)
        if gone:
            raise ValueError(f"{name} has no columns {sorted(gone)}")
        entry = {"name": name, "format": "parquet", "path": f"outputs/{name}", "schema": json.loads(df.schema.json()),
                 "bucketed_by": by, "buckets": buckets, "provenance": (provenance or {}).get(name, {})}
        like = all(old.get(name, {}).get(k) == entry[k] for k in ("schema", "bucketed_by", "buckets"))
        earlier = _buckets(spark, root, after, old[name]) if like else spark.createDataFrame([], BUCKETS)
        keyed = T.StructType([df.schema[c] for c in by])
        bucket = F.pmod(F.xxhash64(digest_text(keyed)), F.lit(buckets))
        found = content_digest(df, bucket).withColumnRenamed("group", "bucket")
        known = earlier.select("bucket", F.col("rows").alias("_rows"), F.col("digest").alias("_digest"), "held_by")
        same = (F.col("rows") == F.col("_rows")) & (F.col("digest") == F.col("_digest"))
        judged = found.join(known, "bucket", "left").select(
            "bucket", "rows", "digest", F.when(same, F.col("held_by")).otherwise(F.lit(checkpoint_id)).alias("held_by"))
        judged.write.parquet(f"{folder}/buckets/{name}")
        listed = spark.read.schema(BUCKETS).parquet(f"{folder}/buckets/{name}")
        entry["rows"] = listed.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        entry["content_digest"] = table_digest(listed.select("bucket", "rows", "digest"))[1]
        entry["sha256"] = table_digest(listed)[1]
        # At most `buckets` numbers.
        changed = [r["bucket"] for r in listed.filter(F.col("held_by") == checkpoint_id).select("bucket").collect()]
        if changed:
            at = _unused("_bucket", df.columns)
            rows = df.withColumn(at, bucket)
            (rows.filter(F.col(at).isin(changed)).hint("rebalance", at).write.partitionBy(at)
             .option("maxRecordsPerFile", 5_000_000).parquet(f"{folder}/outputs/{name}"))
        entries.append(entry)
    return _commit(spark, root, checkpoint_id, scope, entries)


def _buckets(spark: SparkSession, root: str, checkpoint_id: str, entry: dict) -> DataFrame:
    """The bucket table of a saved table, as its manifest knows it."""
    listed = spark.read.schema(BUCKETS).parquet(f"{root}/checkpoints/data/{checkpoint_id}/buckets/{entry['name']}")
    if table_digest(listed)[1] != entry["sha256"]:
        raise ContractError(f"hash mismatch: buckets of {entry['name']}")
    return listed


def _collected(spark: SparkSession, root: str, checkpoint_id: str, entry: dict) -> DataFrame:
    """A table put together from the buckets that this and earlier checkpoints hold, each verified by its digest."""
    schema, name = T.StructType.fromJson(entry["schema"]), entry["name"]
    listed = _buckets(spark, root, checkpoint_id, entry)
    held = [(r["bucket"], r["held_by"]) for r in listed.select("bucket", "held_by").collect()]
    if not held:
        return spark.createDataFrame([], schema)
    at = _unused("_bucket", schema.names)
    table = spark.read.schema(schema).parquet(
        *[f"{root}/checkpoints/data/{holder}/outputs/{name}/{at}={bucket}" for bucket, holder in sorted(held)])
    keyed = T.StructType([schema[c] for c in entry["bucketed_by"]])
    found = content_digest(table, F.pmod(F.xxhash64(digest_text(keyed)), F.lit(entry["buckets"])))
    both = listed.join(found.select(F.col("group").alias("bucket"), F.col("rows").alias("_rows"), F.col("digest").alias("_digest")),
                       "bucket", "full")
    bad = both.filter(~(F.col("rows").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest")))).take(1)
    if bad:
        raise ContractError(f"hash mismatch: bucket {bad[0]['bucket']} of {name}")
    return table


def listing(spark: SparkSession, root: str) -> DataFrame:
    return artifacts.manifests(spark, f"{root}/checkpoints").select(F.col("folder").alias("checkpoint_id")).distinct()


def _manifest(spark: SparkSession, root: str, checkpoint_id: str, scope: str) -> dict:
    """The manifest of a checkpoint, verified."""
    lines = [r["text"] for r in artifacts.manifests(spark, f"{root}/checkpoints").filter(
        F.col("folder") == checkpoint_id).collect()]
    text = next((line for line in lines if line.startswith("{")), None)
    if text is None:
        raise ContractError("checkpoint not found")
    if code_digest(text) not in lines:
        raise ContractError("hash mismatch: checkpoint manifest")
    manifest = json.loads(text)
    if (manifest["schema_version"], manifest["checkpoint_id"], manifest["scope_id"]) != (CHECKPOINT_VERSION, checkpoint_id, scope):
        raise ContractError("checkpoint version, identity or scope does not match")
    if manifest["spark_version"] != pyspark.__version__:
        raise ContractError("checkpoint was written by another Spark version")
    return manifest


def restore(spark: SparkSession, root: str, checkpoint_id: str, scope: str) -> dict[str, DataFrame]:
    """The tables of a checkpoint, after its manifest and every part file or bucket have been verified."""
    manifest = _manifest(spark, root, checkpoint_id, scope)
    folder = f"{root}/checkpoints/data/{checkpoint_id}"
    whole = [e for e in manifest["tables"] if "buckets" not in e]
    if whole:
        artifacts.verify_tables(spark, folder, whole)
    tables = {e["name"]: _collected(spark, root, checkpoint_id, e) if "buckets" in e
              else spark.read.schema(T.StructType.fromJson(e["schema"])).parquet(f"{folder}/{e['path']}")
              for e in manifest["tables"]}
    if ASSETS in tables:
        # The saved copies stand in for the original files.
        here = F.concat(F.lit(f"{folder}/outputs/{ASSETS}#"), F.col("asset_id"))
        tables[ASSETS] = tables[ASSETS].withColumn("path", here)
    return tables

"""Content digests, recipe hashes and the lookup of earlier runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.functions.canonical import canonical, digest, digest_text, hash_number
from factline.operators.code import code_digest  # noqa: F401


def content_digest(df: DataFrame, group: Column | None = None) -> DataFrame:
    """One row `(rows, digest)` that is the same for the same rows in any order.

    Every row is hashed where it lies; only a count and two sums leave each task. Copies
    count, so the digest also changes when a row is repeated. With `group` there is one
    digest for each of its values.
    """
    schema_text = canonical([[f.name, f.dataType.simpleString()] for f in df.schema.fields])
    named = [] if group is None else [group.alias("group")]
    keys = ["group"] if named else []
    hashed = df.select(*named, digest_text(df.schema).alias("_text")).select(
        *keys, hash_number(F.col("_text"), 1).alias("_a"), hash_number(F.col("_text"), 16).alias("_b"))
    sums = hashed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    zero = F.lit(0).cast("decimal(38,0)")
    total = F.concat_ws(":", F.lit(schema_text), F.col("rows").cast("string"),
                        F.coalesce("_a", zero).cast("string"), F.coalesce("_b", zero).cast("string"))
    return sums.select(*keys, "rows", F.sha2(total, 256).alias("digest"))


def table_digest(df: DataFrame) -> tuple[int, str]:
    row = content_digest(df).first()
    return row["rows"], row["digest"]


def recipe_hash(recipe: dict) -> str:
    """Identity of a run: a hash of everything that may change its outputs."""
    return digest(recipe)


def recipe_column(*fields: str) -> Column:
    """Recipe hash of rows that carry recipe fields as text columns."""
    parts = []
    for name in sorted(fields):
        value = F.to_json(F.array(name))
        parts += [F.lit(("," if parts else "{") + f'"{name}":'), F.substring(value, F.lit(2), F.length(value) - 2)]
    return F.sha2(F.concat(*parts, F.lit("}")), 256)


def find_reusable(runs: DataFrame, index: DataFrame) -> DataFrame:
    """Requested runs with the first published artifact of the same recipe, if any.

    An artifact whose recorded digest no longer matches is to be reloaded, not reused in place.
    """
    published = index.groupBy("recipe_hash").agg(
        F.min_by(F.struct("artifact_id", "content_digest"), F.struct("created_at", "artifact_id")).alias("_p"))
    return runs.join(published, "recipe_hash", "left").select(
        *runs.columns, F.col("_p.artifact_id").alias("artifact_id"),
        F.when(F.col("_p").isNull(), "run")
        .when(F.col("_p.content_digest").eqNullSafe(F.col("current_digest")), "reuse tables")
        .otherwise("reload artifact").alias("action"),
    )


def rewrite_paths(images: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace `path` from a `(original_ref, path, ordinal)` mapping; the last entry of a ref wins."""
    last = mapping.groupBy("original_ref").agg(F.max_by("path", "ordinal").alias("_path"))
    return images.join(last, "original_ref", "left").select(
        *[F.coalesce("_path", "path").alias("path") if c == "path" else c for c in images.columns])

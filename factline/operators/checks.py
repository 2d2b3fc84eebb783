"""Contract and integrity checks. Each gives the rows that break a rule, with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factline.functions import locators
from factline.functions.once import once
from factline.functions.text import UUID

# The columns of the published tables, all text.
FIXED_COLUMNS = {
    "documents": ["document_key", "title", "markdown"],
    "evidence": ["evidence_id", "asset_id", "locator_json", "quote"],
    "images": ["original_ref", "path", "mime_type"],
}
# What an artifact may hold.
FORMATS = ["parquet", "jsonl", "markdown", "png", "jpeg", "webp"]
KINDS = ["document", "table", "evidence", "image"]
IMAGE_TYPES = ["image/png", "image/jpeg", "image/webp"]
SHA256 = "^[0-9a-f]{64}$"
CREATED_AT = r"^\d{4}-\d{2}-\d{2}T.*Z$"
MANIFEST_SCHEMA = (
    "schema_version string, artifact_id string, scope_id string, created_at string, recipe_hash string, "
    "package struct<id:string,version:string,digest:string>, "
    "sources array<struct<asset_id:string,sha256:string,media_type:string,original_name:string,path:string>>, "
    "outputs array<struct<name:string,kind:string,format:string,path:string,sha256:string,rows:bigint>>"
)


class ContractError(ValueError):
    """A published table or file set breaks its contract."""


def fixed_schema(schema: T.StructType, logical: str) -> list[str]:
    """Problems of a published table's columns; a check of metadata that runs no job."""
    expected = FIXED_COLUMNS.get(logical)
    if expected is None:
        return []
    problems = []
    if schema.fieldNames() != expected:
        problems.append(f"columns are {schema.fieldNames()}, not {expected}")
    problems += [f"{f.name} is {f.dataType.simpleString()}, not string"
                 for f in schema.fields if f.name in expected and not isinstance(f.dataType, T.StringType)]
    return problems


def check_evidence(evidence: DataFrame, assets: DataFrame) -> DataFrame:
    """Evidence rows that break a rule.

    `assets` has one row per `asset_id`; where it has a column `pages`, locators are held
    against that page count.
    """
    pages = F.col("pages") if "pages" in assets.columns else F.lit(None)
    known = assets.select("asset_id", F.lit(True).alias("_known"), pages.cast("bigint").alias("pages"))
    document = F.col("_document")
    locator = F.col("locator_json")
    plain = F.coalesce(locator.rlike(locators.PLAIN), F.lit(False))
    shown = ["evidence_id", "asset_id", "locator_json", "_page", "_problem"]
    no_text = F.when(F.col("quote").isNull(), "quote is not text")
    # What the row alone can tell is settled before the join, so that quotes are not shuffled. Plain locators go apart: the
    # code for all rules in one is too long for Java to compile, and each row would be interpreted.
    settled = evidence.filter(plain).select("*", locators.plain_page(locator).alias("_page"), no_text.alias("_problem")).select(*shown)
    parsed = once(evidence.filter(~plain), _document=F.try_parse_json(locator))
    paged = once(parsed, _page=locators.whole_number(document, "$.page"))
    judged = settled.unionByName(once(paged, _problem=no_text.otherwise(locators.locator_problem(document))).select(*shown))
    reason = (
        F.when(F.coalesce("evidence_id", F.lit("")) == "", "evidence id is empty")
        .when(F.col("_known").isNull(), "asset is not loaded")
        .otherwise(F.coalesce("_problem", F.when(F.col("_page") > F.col("pages"), "page exceeds the source")))
    )
    return (
        judged.join(known, "asset_id", "left")
        .select("evidence_id", "asset_id", "locator_json", reason.alias("reason"))
        .filter(F.col("reason").isNotNull())
    )


def orphans(evidence: DataFrame, assets: DataFrame) -> DataFrame:
    """Evidence that names an asset which is not loaded."""
    return evidence.join(assets.select("asset_id"), "asset_id", "left_anti")


def verify_files(manifest: DataFrame, rescan: DataFrame) -> DataFrame:
    """Every listed file against a fresh scan: ok, missing, mismatch, or unlisted."""
    listed = manifest.select("path", F.col("sha256").alias("expected"))
    found = rescan.select("path", F.col("sha256").alias("actual"))
    status = (
        F.when(F.col("actual").isNull(), "missing")
        .when(F.col("expected").isNull(), "unlisted")
        .when(F.col("expected") == F.col("actual"), "ok")
        .otherwise("mismatch")
    )
    return listed.join(found, "path", "full_outer").select("path", "expected", "actual", status.alias("status"))


def check_images(images: DataFrame, files: DataFrame) -> DataFrame:
    """Image rows without bytes, with an unsupported type, or whose bytes are not that type."""
    head = F.col("_head")
    looks_like = (
        F.when(head.startswith("89504E470D0A1A0A"), "image/png")
        .when(head.startswith("FFD8FF"), "image/jpeg")
        .when(head.startswith("52494646") & head.endswith("57454250"), "image/webp")
    )
    reason = (
        F.when(head.isNull(), "image file is missing")
        .when(~F.col("mime_type").isin(IMAGE_TYPES), "media type is not supported")
        .when(~F.coalesce(looks_like == F.col("mime_type"), F.lit(False)), "bytes are not that image type")
    )
    # Only the first bytes take part in the join.
    heads = files.select("path", F.hex(F.substring("content", 1, 12)).alias("_head"))
    return images.join(heads, "path", "left").select(
        "original_ref", "path", "mime_type", reason.alias("reason")).filter(F.col("reason").isNotNull())


def _bad(rule: Column) -> Column:
    return ~F.coalesce(rule, F.lit(False))


def sound_path(path: Column) -> Column:
    """A normalized relative POSIX path."""
    return (
        path.isNotNull() & (path != "") & ~F.contains(path, F.lit("\\")) & ~path.startswith("/")
        & ~path.rlike(r"(^|/)(\.\.?)(/|$)") & ~F.contains(path, F.lit("//")) & ~path.endswith("/")
    )


def check_manifests(manifests: DataFrame, scope: str, schema_version: str) -> DataFrame:
    """Status of each manifest `(folder, text)`: `ok` or the first rule it breaks."""
    m = F.from_json("text", MANIFEST_SCHEMA + ", _corrupt_record string")
    rules: list[tuple[Column, str]] = [
        (F.col("_m._corrupt_record").isNotNull() | ~F.ltrim("text").startswith("{"), "contract invalid"),
        (_bad(F.col("_m.schema_version") == schema_version), "contract invalid"),
        (_bad(F.col("_m.artifact_id").rlike(f"^{UUID}$")), "contract invalid"),
        (_bad(F.length("_m.scope_id") > 0), "contract invalid"),
        (_bad(F.col("_m.created_at").rlike(CREATED_AT)), "contract invalid"),
        (_bad(F.col("_m.recipe_hash").rlike(SHA256)), "contract invalid"),
        (_bad(F.col("_m.package.id").isNotNull() & F.col("_m.package.version").isNotNull()
              & F.col("_m.package.digest").rlike(SHA256)), "contract invalid"),
        (F.col("_m.sources").isNull() | F.exists("_m.sources", lambda s: _bad(
            s["asset_id"].isNotNull() & s["sha256"].rlike(SHA256) & s["media_type"].isNotNull()
            & s["original_name"].isNotNull() & (F.length(s["path"]) > 0))), "contract invalid"),
        (_bad(F.size("_m.outputs") > 0) | F.exists("_m.outputs", lambda o: _bad(
            (F.length(o["name"]) > 0) & o["kind"].isin(KINDS) & o["format"].isNotNull()
            & o["sha256"].rlike(SHA256) & (F.length(o["path"]) > 0)
            & (o["rows"].isNull() | (o["rows"] >= 0)))), "contract invalid"),
        (_bad(F.col("_m.artifact_id") == F.col("folder")) | _bad(F.col("_m.scope_id") == scope), "scope mismatch"),
        (F.size(F.array_distinct("_m.outputs.name")) != F.size("_m.outputs"), "contract invalid"),
        (F.exists("_m.outputs", lambda o: ~o["format"].isin(FORMATS)), "format unsupported"),
        (F.exists("_m.sources", lambda s: _bad(sound_path(s["path"])))
         | F.exists("_m.outputs", lambda o: _bad(sound_path(o["path"]))), "invalid path"),
    ]
    status = F.lit(None).cast("string")
    for broken, reason in reversed(rules):
        status = F.when(broken, reason).otherwise(status)
    return once(manifests.select("folder", "text"), _m=m).select(
        "folder", F.when(F.col("_m._corrupt_record").isNull(), F.col("_m.artifact_id")).alias("artifact_id"),
        F.coalesce(status, F.lit("ok")).alias("status")
    )


def require_none(violations: DataFrame, what: str) -> None:
    """Strict mode: fail when a violations table has any row."""
    found = violations.agg(F.count(F.lit(1)).alias("rows"), F.first(F.struct(*violations.columns)).alias("example")).first()
    if found["rows"]:
        raise ContractError(f"{what}: {found['rows']} violations, such as {found['example'].asDict()}")

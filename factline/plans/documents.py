"""The document ingest: CSV files, paged text and images to documents, evidence and facts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.functions import text
from factline.operators import observations, publish, replies
from factline.operators.checks import require_none
from factline.operators.compare import duplicate_keys
from factline.plans import ingest
from factline.storage import fresh_path, keep

#: Tasks that store the assets at most, or eight for each core where those are more.
STORE_TASKS = 64


@dataclass(frozen=True)
class Model:
    """A named reader of documents: the function takes a request body and gives the reply text."""

    alias: str
    base_prompt: str
    reply_to: Callable[[str], str]
    temperature: float = observations.TEMPERATURE
    max_tokens: int = observations.MAX_TOKENS


def read_documents(assets: DataFrame, pages: DataFrame | None) -> DataFrame:
    """One row per asset with its text and page count. Fails when an asset has no reader.

    File bytes never enter a join: paged documents need only their id, the others need no
    join. Bytes are kept for images alone.
    """
    routed = observations.route_assets(assets)
    require_none(duplicate_keys(assets.select("asset_id"), ["asset_id"]), "asset ids")
    require_none(routed.filter(F.col("route") == "rejected").select("asset_id", "reason"), "documents")
    named = ["asset_id", "original_name", "media_type", "route"]
    image = F.col("route") == "image"
    whole = routed.filter(F.col("route") != "pages").select(
        *named,
        F.when(image, observations.IMAGE_MARKDOWN).otherwise(text.file_text(F.col("content"))).alias("markdown"),
        F.lit(None).cast("bigint").alias("pages"),
        F.when(image, F.col("content")).alias("content"),
    )
    paged = routed.filter(F.col("route") == "pages").select(*named)
    if pages is None:
        paged = paged.withColumn("markdown", F.lit("")).withColumn("pages", F.lit(0).cast("bigint"))
    else:
        counts = pages.groupBy("asset_id").agg(F.count(F.lit(1)).alias("pages"))
        joined = observations.join_pages(pages).select("asset_id", "markdown")
        paged = paged.join(counts, "asset_id", "left").join(joined, "asset_id", "left").select(
            *named, F.coalesce("markdown", F.lit("")).alias("markdown"), F.coalesce("pages", F.lit(0)).alias("pages"))
    return whole.unionByName(paged.withColumn("content", F.lit(None).cast("binary")))


def read_without_model(documents: DataFrame, pages: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Evidence elements and observations by the declared grammar; images and scans are refused."""
    marked = observations.need_model(documents)
    require_none(marked.filter("model_required").select("asset_id", "media_type"), "a model is required")
    records = keep(observations.csv_records(documents.filter("route = 'records'")), "records")
    elements = records.select("asset_id", "key", "locator_json", "quote")
    observed = records.select("asset_id", "key", "item", "value", "category")
    if pages is not None:
        elements = elements.unionByName(observations.page_evidence(pages))
        observed = observed.unionByName(observations.page_observations(pages).drop("pos"))
    return elements, observed


def read_with_model(documents: DataFrame, model: Model, prompt: str, memo: str) -> tuple[DataFrame, DataFrame]:
    """Evidence elements and observations from the model's replies, for every document; `memo` holds those of earlier runs."""
    marked = observations.need_model(documents)
    require_none(marked.filter(F.col("model_problem").isNotNull()).select("asset_id", "model_problem"), "model limit")
    whole = documents.select("asset_id", "media_type", "markdown", "content")
    requests = observations.model_requests(whole, model.base_prompt, model.alias, prompt, model.temperature, model.max_tokens)
    replied = keep(replies.with_replies(requests.select("asset_id", "media_type", "request"), model.reply_to, memo), "replies")
    records, rejected = observations.sanitize_replies(replied)
    require_none(rejected, "model reply")
    return records.select("asset_id", "key", "locator_json", "quote"), records.select("asset_id", "key", "item", "value", "category")


def document_spec(model: Model | None = None, prompt: str = "", multiplier: float = 1, memo: str = "") -> ingest.PipelineSpec:
    """The ingest as a declared pipeline over `assets` (with content) and, for paged text, `pages`."""

    def read(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
        return keep(read_documents(tables["assets"], tables.get("pages")), "documents")

    def elements(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
        if model is None:
            found, observed = read_without_model(tables["read"], tables.get("pages"))
        else:
            found, observed = read_with_model(tables["read"], model, prompt, memo or fresh_path(spark, "memo"))
        tables["observed"] = observed
        return found

    return ingest.PipelineSpec(
        id="document_ingest", version="1.0.0", params=("multiplier", "model_alias", "prompt"),
        steps=[
            ("read", read),
            ("elements", elements),
            ("documents", lambda spark, tables: publish.documents_of(tables["read"])),
            ("evidence", lambda spark, tables: publish.evidence_of(tables["elements"])),
            ("facts", lambda spark, tables: publish.facts_of(observations.scale(tables["observed"], multiplier))),
        ],
        outputs={"documents": "documents", "evidence": "evidence", "facts": "facts"},
    )


def ingest_documents(
    spark: SparkSession,
    assets: DataFrame,
    root: str,
    scope: str,
    pages: DataFrame | None = None,
    model: Model | None = None,
    prompt: str = "",
    multiplier: float = 1,
) -> dict:
    """Publish documents, evidence and facts of the assets, or return the equal earlier run.

    `pages` is the text of paged documents, `(asset_id, page, text)`; decoding the files is the
    caller's. With a model every document is read by it, and its output is not guaranteed to
    repeat, but a reply once given is kept under `root` and not asked for again. Any asset, reply or row that breaks a rule stops the run, and nothing is published.
    """
    # Stored: files are read several times over, and listing and opening many small ones costs more than their bytes.
    # Spark reads a few small files a task, each of which would store a small file in turn.
    assets = keep(assets.coalesce(max(STORE_TASKS, 8 * spark.sparkContext.defaultParallelism)), "assets")
    inputs = {"assets": assets} if pages is None else {"assets": assets, "pages": pages}
    params = {"multiplier": multiplier, **({"model_alias": model.alias, "prompt": prompt} if model else {})}
    spec = document_spec(model, prompt, multiplier, f"{root}/replies")
    result = ingest.run(spark, spec, inputs, params, root, scope, asset_table="read")
    warning = ["model output is not guaranteed to repeat; model, prompt and inputs are part of the recipe"] if model else []
    return {**result, "warnings": warning}

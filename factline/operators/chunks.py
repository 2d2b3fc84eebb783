"""Knowledge chunks from landed page envelopes: assembly, completeness and markers.

An envelope is one answer page: `(knowledge_id, page, success, total, data)`, where `data`
is an array of chunks. A page is small by construction; a document may have any number of
pages and chunks, so nothing here gathers a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.functions import text
from factline.operators.numbering import BLOCK, running_totals
from factline.storage import keep

ENVELOPE_SCHEMA = (
    "knowledge_id string, page bigint, success boolean, total bigint, "
    "data array<struct<id:string,knowledge_id:string,chunk_index:bigint,content:string>>"
)
PARTIAL = "Not every declared chunk was read."
REPEATED = "A page brought only known chunks, so reading stopped there."
TOTAL_CHANGED = "Pages declare different totals."


def _problem() -> Column:
    foreign = F.exists("data", lambda c: F.coalesce(c["knowledge_id"] != F.col("knowledge_id"), F.lit(False)))
    hollow = F.exists("data", lambda c: c["id"].isNull() | c["content"].isNull())
    return (
        F.when(F.col("success").eqNullSafe(False) | F.col("data").isNull(), "failure reported or data omitted")
        .when(F.coalesce(foreign, F.lit(False)) | F.coalesce(hollow, F.lit(False)), "invalid chunk identity or content")
    )


def bad_envelopes(envelopes: DataFrame) -> DataFrame:
    """Answer pages that break the response rules, with the reason."""
    return envelopes.select("knowledge_id", "page", _problem().alias("reason")).filter(F.col("reason").isNotNull())


def checked(envelopes: DataFrame) -> DataFrame:
    """The same pages; the job fails at one that breaks the response rules."""
    said = F.concat(F.lit("response invalid: "), _problem(), F.lit(", document "), F.coalesce("knowledge_id", F.lit("")))
    return envelopes.filter(F.when(_problem().isNull(), True).otherwise(F.raise_error(said).cast("boolean")))


def page_rows(envelopes: DataFrame) -> DataFrame:
    """One row per landed page with its size and declared total."""
    return envelopes.select(
        "knowledge_id", "page", F.size("data").cast("bigint").alias("rows"),
        F.when(F.col("total") >= 0, F.col("total")).alias("declared"),
    )


def chunk_rows(envelopes: DataFrame) -> DataFrame:
    """One row per landed chunk, with its place of arrival."""
    chunk = F.col("_c")
    return envelopes.select("knowledge_id", "page", F.posexplode("data").alias("pos", "_c")).select(
        chunk["id"].alias("chunk_id"), "knowledge_id", chunk["chunk_index"].alias("chunk_index"),
        chunk["content"].alias("content"), "page", F.col("pos").cast("bigint").alias("pos"),
    )


def first_copies(chunks: DataFrame) -> DataFrame:
    """The first copy of every chunk id by (page, position). Copies are combined before the shuffle."""
    kept = ["chunk_index", "content", "page", "pos"]
    first = F.min_by(F.struct(*kept), F.struct("page", "pos"))
    return chunks.groupBy("knowledge_id", "chunk_id").agg(first.alias("_first")).select(
        "chunk_id", "knowledge_id", *[F.col("_first")[c].alias(c) for c in kept]
    )


def _ends(envelopes: DataFrame, requested: DataFrame | None, block: int) -> tuple[DataFrame, DataFrame]:
    """The stored page table, and the stored stopping page of each document."""
    landed = page_rows(envelopes).groupBy("knowledge_id", "page").agg(
        F.max("rows").alias("rows"), F.max("declared").alias("declared")
    )
    # Where each chunk id is first seen, without its text.
    arrivals = chunk_rows(envelopes).groupBy("knowledge_id", "chunk_id").agg(F.min("page").alias("page"))
    added = arrivals.groupBy("knowledge_id", "page").agg(F.count(F.lit(1)).alias("added"))
    pages = landed.join(added, ["knowledge_id", "page"], "left").withColumn("added", F.coalesce("added", F.lit(0)))
    pages = pages.withColumn("one", F.lit(1).cast("bigint"))
    sums = {"seen": "rows", "distinct_chunks": "added", "pages_so_far": "one"}
    if requested is not None:
        wanted = requested.select("knowledge_id", "chunk_id").distinct()
        hits = (
            arrivals.join(wanted, ["knowledge_id", "chunk_id"], "left_semi")
            .groupBy("knowledge_id", "page").agg(F.count(F.lit(1)).alias("hits"))
        )
        needed = wanted.groupBy("knowledge_id").agg(F.count(F.lit(1)).alias("needed"))
        pages = (
            pages.join(hits, ["knowledge_id", "page"], "left").join(needed, "knowledge_id")
            .withColumn("hits", F.coalesce("hits", F.lit(0)))
        )
        sums["found"] = "hits"
    # Pages carry no text. They are used several times below, so they are stored, not read again
    # from the envelopes.
    pages = keep(pages, "pages")
    totals = running_totals(pages, "knowledge_id", "page", sums, {"total": "declared"}, block)
    satisfied = (F.col("found") >= F.col("needed")) if requested is not None else F.lit(False)
    ended = (F.col("rows") == 0) | F.coalesce(F.col("seen") >= F.col("total"), F.lit(False))
    read = totals.filter(F.col("pages_so_far") == F.col("page"))
    stop = F.when(satisfied, "requested").when(ended, "ended").when(F.col("added") == 0, "repeated")
    stops = read.withColumn("stop", stop)
    # The stopping page, or the last page read when none stops.
    place = F.struct(F.when(F.col("stop").isNotNull(), 0).otherwise(1), F.when(F.col("stop").isNotNull(), F.col("page")).otherwise(-F.col("page")))
    ends = stops.groupBy("knowledge_id").agg(
        F.min_by(F.struct("page", "seen", "distinct_chunks", "total", "rows", "stop"), place).alias("_end")
    ).select(
        "knowledge_id", F.col("_end.page").alias("fetched_pages"), F.col("_end.seen").alias("seen"),
        F.col("_end.distinct_chunks").alias("distinct_chunks"), F.col("_end.total").alias("total"),
        F.col("_end.rows").alias("_rows"), F.col("_end.stop").alias("stop"),
    )
    # Stored, so that Spark knows its size when it plans the joins with chunk text.
    return pages, keep(ends, "ends")


def walk(envelopes: DataFrame, requested: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Where reading each document stops, and why; one row per document.

    Pages are read in order from 1. Reading stops at the first page that completes the
    requested ids, is empty or reaches the declared total, or adds nothing new.
    """
    pages, ends = _ends(envelopes, requested, block)
    changed = _total_changes(pages, ends)
    everything = F.when(F.col("total").isNull(), F.col("_rows") == 0).otherwise(F.col("distinct_chunks") == F.col("total"))
    return ends.join(changed, "knowledge_id", "left").select(
        "knowledge_id", "fetched_pages", "seen", "distinct_chunks", "total", "stop",
        F.coalesce("_changed", F.lit(False)).alias("total_changed"),
        F.coalesce((F.col("stop") == "ended") & everything, F.lit(False)).alias("all_read"),
    )


def _total_changes(pages: DataFrame, ends: DataFrame) -> DataFrame:
    """Documents whose declared totals up to the stopping page are not all the same."""
    until = pages.select("knowledge_id", "page", "declared").join(
        ends.select("knowledge_id", "fetched_pages"), "knowledge_id"
    ).filter(F.col("page") <= F.col("fetched_pages"))
    return until.groupBy("knowledge_id").agg((F.min("declared") != F.max("declared")).alias("_changed"))


def completeness(envelopes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per document: what was read and whether it is everything that was declared."""
    ends = walk(envelopes, None, block)
    warned = F.col("total_changed") | (F.col("stop").eqNullSafe("repeated")) | ~F.col("all_read")
    return ends.select(
        "knowledge_id", "fetched_pages", "seen", "distinct_chunks", "total", "total_changed",
        F.col("stop").eqNullSafe("repeated").alias("repeated"), (~warned).alias("complete"),
        F.concat_ws(" ", F.when(F.col("total_changed"), TOTAL_CHANGED),
                    F.when(F.col("stop").eqNullSafe("repeated"), REPEATED),
                    F.when(~F.col("all_read"), PARTIAL)).alias("warnings"),
    )


def assemble(envelopes: DataFrame, requested: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """The chunks of each document that were read, first copies only.

    Present them with `in_order`; the order columns stay on the rows.
    """
    ends = _ends(envelopes, requested, block)[1].select("knowledge_id", "fetched_pages")
    chosen = first_copies(chunk_rows(envelopes)).join(ends, "knowledge_id").filter(F.col("page") <= F.col("fetched_pages"))
    if requested is not None:
        chosen = chosen.join(requested.select("knowledge_id", "chunk_id").distinct(), ["knowledge_id", "chunk_id"], "left_semi")
    return chosen.select("chunk_id", "knowledge_id", "chunk_index", "content", "page", "pos")


def in_order(chunks: DataFrame) -> DataFrame:
    """Documents together, chunks by index (none counts as 0), then by arrival."""
    return chunks.orderBy("knowledge_id", F.coalesce("chunk_index", F.lit(0)), "page", "pos")


def missing(envelopes: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested chunk ids that no landed page holds."""
    have = chunk_rows(envelopes).select("knowledge_id", "chunk_id")
    return requested.select("knowledge_id", "chunk_id").distinct().join(have, ["knowledge_id", "chunk_id"], "left_anti")


def with_documents(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks with the title of their document. The description is a summary and stays out of the body."""
    titles = documents.select("knowledge_id", "title", "description")
    return chunks.join(titles, "knowledge_id")


def markers(chunks: DataFrame, label: str) -> DataFrame:
    """Artifact ids named in chunk text, once per document, with where each was first seen."""
    place = F.struct(F.coalesce("chunk_index", F.lit(0)).alias("chunk_index"), "page", "pos", "nth")
    found = chunks.select(
        "knowledge_id", "chunk_index", "page", "pos",
        F.posexplode(text.marker_ids(F.col("content"), label)).alias("nth", "artifact_id"),
    )
    first = found.groupBy("knowledge_id", "artifact_id").agg(F.min(place).alias("_p"))
    return first.select("knowledge_id", "artifact_id", F.col("_p.chunk_index").alias("chunk_index"),
                        F.col("_p.page").alias("page"), F.col("_p.pos").alias("pos"), F.col("_p.nth").cast("bigint").alias("nth"))


def marker_status(documents: DataFrame, found: DataFrame, index: DataFrame) -> DataFrame:
    """One status per marked artifact and store, and `no_marker` for documents without one.

    `index` holds `(artifact_id, store_alias, problem)`; a null problem means it verifies.
    """
    known = index.select("artifact_id", "store_alias", "problem", F.lit(True).alias("_known"))
    marked = documents.select("knowledge_id").join(found.select("knowledge_id", "artifact_id"), "knowledge_id", "left")
    status: Column = (
        F.when(F.col("artifact_id").isNull(), "no_marker")
        .when(F.col("_known").isNull(), "unavailable")
        .otherwise(F.coalesce("problem", F.lit("loaded")))
    )
    return marked.join(known, "artifact_id", "left").select(
        "knowledge_id", "artifact_id", status.alias("status"),
        F.when(status == "loaded", F.col("store_alias")).alias("store_alias"),
    )

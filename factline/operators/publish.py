"""The published tables as projections of stored records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAYLOAD_SCHEMA = (
    "title string, markdown string, "
    "evidence array<struct<key:string,locator:string,quote:string>>, "
    "observations array<struct<item:string,value:double,category:string,key:string>>"
)


def evidence_id(asset_id: Column, key: Column) -> Column:
    """`asset:key`; null when either part is null."""
    return F.concat(asset_id, F.lit(":"), key)


def documents_of(documents: DataFrame) -> DataFrame:
    """`(asset_id, original_name, markdown)` as the documents table."""
    return documents.select(
        F.col("asset_id").cast("string").alias("document_key"),
        F.col("original_name").cast("string").alias("title"),
        F.col("markdown").cast("string").alias("markdown"),
    )


def evidence_of(records: DataFrame) -> DataFrame:
    return records.select(
        evidence_id(F.col("asset_id"), F.col("key")).alias("evidence_id"),
        F.col("asset_id").cast("string").alias("asset_id"),
        "locator_json", "quote",
    )


def facts_of(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("item").cast("string").alias("item"), F.col("value").cast("double").alias("value"),
        F.col("category").cast("string").alias("category"),
        evidence_id(F.col("asset_id"), F.col("key")).alias("evidence_id"),
        F.col("asset_id").cast("string").alias("asset_id"),
    )


def in_order(published: DataFrame) -> DataFrame:
    """Evidence or facts by asset and by element number, for presentation.

    A stored table has no order of its own; the number is the part of the id after the asset.
    """
    number = F.expr("try_cast(substring(evidence_id, length(asset_id) + 2) AS BIGINT)")
    return published.orderBy("asset_id", number, "evidence_id")


def _payload(df: DataFrame) -> Column:
    return F.from_json(df["payload"], PAYLOAD_SCHEMA)


def payload_evidence(df: DataFrame) -> DataFrame:
    """Evidence rows with ordinal from `(asset_id, payload)` JSON; empty arrays give no row."""
    element = F.col("_e")
    return df.select(F.col("asset_id").cast("string").alias("asset_id"),
                     F.posexplode(_payload(df)["evidence"]).alias("pos", "_e")).select(
        evidence_id(F.col("asset_id"), element["key"]).alias("evidence_id"), "asset_id",
        element["locator"].alias("locator_json"), element["quote"].alias("quote"), "pos")


def payload_facts(df: DataFrame) -> DataFrame:
    """Observation rows with ordinal from `(asset_id, payload)` JSON."""
    element = F.col("_e")
    return df.select(F.col("asset_id").cast("string").alias("asset_id"),
                     F.posexplode(_payload(df)["observations"]).alias("pos", "_e")).select(
        element["item"].alias("item"), element["value"].alias("value"), element["category"].alias("category"),
        evidence_id(F.col("asset_id"), element["key"]).alias("evidence_id"), "asset_id", "pos")


def fold_params(rows: DataFrame) -> DataFrame:
    """Fold `(name, value_json)` rows into one JSON object; `{}` when there are none.

    Parameters belong to one run, so the object is one cell; a name given twice fails.
    """
    folded = F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value_json"))))
    return rows.agg(F.coalesce(F.to_json(folded), F.lit("{}")).alias("params_json"))

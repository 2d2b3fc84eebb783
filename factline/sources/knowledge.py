"""Landed knowledge pages as documents and envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.operators.chunks import ENVELOPE_SCHEMA

DOCUMENT_SCHEMA = (
    "success boolean, data struct<id:string,knowledge_base_id:string,title:string,file_name:string,description:string>"
)


def load_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Answer pages landed as JSON lines."""
    return spark.read.schema(ENVELOPE_SCHEMA).json(path)


def load_documents(spark: SparkSession, path: str, allowed_bases: list[str]) -> DataFrame:
    """Document rows of the allowed knowledge bases; the title falls back to the file name, then the id."""
    d = F.col("data")
    return (
        spark.read.schema(DOCUMENT_SCHEMA).json(path)
        .filter(~F.col("success").eqNullSafe(False) & d["id"].isNotNull() & d["knowledge_base_id"].isin(allowed_bases))
        .select(d["id"].alias("knowledge_id"), F.coalesce(d["title"], d["file_name"], d["id"]).alias("title"),
                F.coalesce(d["description"], F.lit("")).alias("description"))
    )

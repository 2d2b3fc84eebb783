"""The append-only log of operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.functions.canonical import canonical

LOG_SCHEMA = (
    "operation_id string, action string, request_digest string, request string, status string, "
    "input_tables string, output_tables string, started_at string, finished_at string"
)


def append(spark: SparkSession, folder: str, entry: dict) -> None:
    """Each operation is its own file, so concurrent writers do not touch each other's."""
    row = {k: v if v is None or isinstance(v, str) else canonical(v) for k, v in entry.items()}
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.json(f"{folder}/operation={entry['operation_id']}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).option("basePath", folder).json(folder).drop("operation")


def last_operations(log: DataFrame, at: str = "finished_at", tie: str = "operation_id", n: int = 20) -> DataFrame:
    """The latest n operations; a top-n, so no full sort."""
    return log.orderBy(F.col(at).desc(), F.col(tie).desc()).limit(n)

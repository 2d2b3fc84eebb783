"""Where intermediate tables are written, and how they are read back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; the warehouse folder where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work").rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid4().hex}"


def keep(df: DataFrame, label: str = "table", max_records_per_file: int = 5_000_000) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The copy is computed once, survives lost executors and can be read column by column,
    so several outputs can be taken from it without running the plan again.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", max_records_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

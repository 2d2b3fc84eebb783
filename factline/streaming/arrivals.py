"""Follow-up files that arrive in a folder, taken once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def take_arrivals(
    spark: SparkSession,
    folder: str,
    schema: str,
    progress: str,
    land: Callable[[DataFrame, int], None],
) -> None:
    """Hand every CSV file that has not been taken yet to `land`, then stop.

    The stream's progress folder remembers which files were taken. `land` gets a batch and
    its number; write under that number, so a batch repeated after a failure replaces itself.
    """
    arrivals = (
        spark.readStream.schema(schema).option("header", "true").csv(folder)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )
    query = (
        arrivals.writeStream.foreachBatch(land)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

"""Read-only query results from a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_options(
    url: str,
    query: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of the JDBC read. Give a partition column and bounds so the read is parallel."""
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if partition_column is None:
        return {**options, "query": query}
    if bounds is None or partitions is None:
        raise ValueError("a partitioned read needs bounds and a number of partitions")
    return {
        **options,
        "dbtable": f"({query}) q",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


class SourceError(RuntimeError):
    """A database read failed; the driver's own text is not repeated."""


def load_query(spark: SparkSession, url: str, query: str, max_rows: int | None = None, **options) -> DataFrame:
    """The query's result. With `max_rows` a longer result is refused, not cut."""
    table = spark.read.format("jdbc").options(**query_options(url, query, **options)).load()
    if max_rows is not None:
        try:
            too_long = table.limit(max_rows + 1).count() > max_rows
        except Exception:
            raise SourceError("read-only query failed; check bindings, permission and timeout") from None
        if too_long:
            raise SourceError(f"query gives more than {max_rows} rows")
    return table

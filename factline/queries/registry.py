"""The query table and small shared inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under its key, with the SQL it is checked against."""

    def wrap(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def on_tables(spark: SparkSession, sf_dir: str, sql: str, args=None) -> DataFrame:
    """Run SQL that names the given tables as `{orders}` and so on."""
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
             "embeddings", "pages", "benchmark", "labels", "conversations"]
    used = {n: table(spark, sf_dir, n) for n in names if "{" + n + "}" in sql}
    return spark.sql(sql, args=args, **used)


def order_facts(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """Orders as facts: the item is the customer, the category the priority."""
    orders = table(spark, sf_dir, "orders")
    if year is not None:
        first, after = f"{year}-01-01", f"{year + 1}-01-01"
        orders = orders.filter((F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
                               & (F.col("o_orderdate") < F.lit(after).cast("timestamp_ntz")))
    return orders.select(
        F.col("o_custkey").alias("item"), F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("value"), F.concat(F.lit("order:"), F.col("o_orderkey")).alias("evidence_id"))

"""Order-aware numbering that never gathers a hot group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factline.storage import fresh_path, keep

# Positions in this many consecutive sequence numbers are totalled first (see running_totals).
BLOCK = 4_096

PART_BITS = 33


def place(df: DataFrame, order: list[str] | None, path: str) -> None:
    """Write the table with each row's place in `_at`: partition and position inside it.

    With an `order` the table is sorted across range partitions first. The arrival number is
    the last sort key, so even a run of equal rows is spread over many partitions. Without
    one the rows keep the order they were computed in. The written copy fixes every place.
    """
    placed = df
    if order:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        keys = [*order, "_arrival"]
        placed = (
            df.withColumn("_arrival", F.monotonically_increasing_id())
            .repartitionByRange(partitions, *keys)
            .sortWithinPartitions(*keys)
            .drop("_arrival")
        )
    placed.withColumn("_at", F.monotonically_increasing_id()).write.option(
        "maxRecordsPerFile", 5_000_000).parquet(path)


def with_place(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_at", T.LongType())])


def part_of(at: Column) -> Column:
    return F.shiftright(at, PART_BITS)


def position_of(at: Column) -> Column:
    return at.bitwiseAND(F.lit((1 << PART_BITS) - 1))


def _placed(df: DataFrame, order: list[str], label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    place(df, order, path)
    stored = df.sparkSession.read.schema(with_place(df.schema)).parquet(path)
    at = F.col("_at")
    return stored.select(*df.columns, part_of(at).alias("_part"), position_of(at).alias("_pos"))


def number_within(df: DataFrame, group: list[str], order: list[str], start: int = 1, name: str = "n") -> DataFrame:
    """Number the rows of each group in `order`, counting from `start`.

    The table is range-sorted and stored; each partition then contributes one count per group
    it holds, and a row's number is its position plus the rows its group has in earlier
    partitions. Give a total order for repeatable numbers.
    """
    placed = _placed(df, [*group, *order], "numbered")
    earlier = Window.partitionBy(*[f"_g{i}" for i in range(len(group))]).orderBy("_p")
    # Stored, so that Spark plans the join with its real size and moves the rows only if it must.
    starts = keep(
        placed.groupBy(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)])
        .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(
            F.sum("_rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))),
        "starts",
    )
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(starts, same).select(
        *df.columns, (F.col("_pos") - F.col("_first") + F.col("_before") + start).cast("bigint").alias(name)
    )


def number_all(df: DataFrame, order: list[str], name: str = "_row") -> DataFrame:
    """Dense numbers from 0 over the whole table in `order`, without a single-task sort."""
    placed = _placed(df, order, "rows")
    # One count per stored partition: a table of at most spark.sql.shuffle.partitions rows.
    sizes = placed.groupBy(F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = keep(sizes.select("_p", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")), "starts")
    return placed.join(starts, F.col("_part") == F.col("_p")).select(
        *df.columns, (F.col("_pos") + F.col("_before")).cast("bigint").alias(name)
    )


def running_totals(
    df: DataFrame,
    group: str,
    sequence: str,
    totals: dict[str, str],
    latest: dict[str, str] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Running sums and last known values along an integer sequence, in two levels.

    The sequence is cut into fixed blocks. Block totals are carried forward with a window
    over blocks, and rows are accumulated inside their own block, so one very long group
    costs many small tasks and not one large one. `totals` maps an output name to the column
    summed; `latest` maps an output name to the column whose last non-null value is carried.
    """
    latest = latest or {}
    cut = df.withColumn("_block", F.floor(F.col(sequence) / block).cast("bigint"))
    per_block = cut.groupBy(F.col(group).alias("_g"), F.col("_block").alias("_b")).agg(
        *[F.sum(source).alias(f"_sum_{out}") for out, source in totals.items()],
        *[F.max_by(source, F.when(F.col(source).isNotNull(), F.col(sequence))).alias(f"_last_{out}")
          for out, source in latest.items()],
        F.count(F.lit(1)).alias("_rows"),
    )
    blocks = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(
        "_g", "_b",
        *[F.coalesce(F.sum(f"_sum_{out}").over(blocks), F.lit(0)).alias(f"_before_{out}") for out in totals],
        *[F.last(f"_last_{out}", ignorenulls=True).over(blocks).alias(f"_before_{out}") for out in latest],
    )
    inside = Window.partitionBy(group, "_block").orderBy(sequence).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_block") == F.col("_b"))
    return cut.join(carried, same).select(
        *df.columns,
        *[(F.coalesce(F.sum(source).over(inside), F.lit(0)) + F.col(f"_before_{out}")).alias(out)
          for out, source in totals.items()],
        *[F.coalesce(F.last(source, ignorenulls=True).over(inside), F.col(f"_before_{out}")).alias(out)
          for out, source in latest.items()],
    )

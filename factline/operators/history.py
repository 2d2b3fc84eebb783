"""The history of a table over numbered runs, kept as changes and read as intervals.

A run appends the rows whose number of copies differs from what the run before it left, with the
new number; nothing else is written. From these changes follow the intervals in which each row
held, any run as it was, and what held at a given run for a given key.

All columns of the table make up the row; equal rows are copies. Nulls are values like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MADE = ["copies", "run"]


def _schema(columns: T.StructType) -> T.StructType:
    clash = {f.name for f in columns.fields} & {*MADE, "from_run", "to_run"}
    if clash:
        raise ValueError(f"columns of a history are named otherwise: {sorted(clash)}")
    return T.StructType([*columns.fields, T.StructField("copies", T.LongType()), T.StructField("run", T.LongType())])


def changes(spark: SparkSession, folder: str, columns: T.StructType) -> DataFrame:
    """Every change `(columns, copies, run)`; 0 copies where a row ends. Empty before the first run."""
    try:
        return spark.read.schema(_schema(columns)).option("basePath", folder).parquet(folder)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], _schema(columns))


def state(log: DataFrame, run: int | None = None) -> DataFrame:
    """How many copies of each row held at a run, by default the last one."""
    columns = [c for c in log.columns if c not in MADE]
    seen = log if run is None else log.filter(F.col("run") <= run)
    return seen.groupBy(*columns).agg(F.max_by("copies", "run").alias("copies")).filter("copies > 0")


def add_run(spark: SparkSession, folder: str, table: DataFrame, run: int) -> None:
    """Append what a run changes. A run added again, such as after a failure, replaces itself; runs come in order.

    Old and new rows are stacked and reduced by row, combined before the shuffle, so no row meets
    another one in a join and a row of any number of copies is one entry.
    """
    earlier = changes(spark, folder, table.schema).filter(F.col("run") < run)
    columns = table.columns
    both = state(earlier).select(*columns, F.col("copies").alias("_old"), F.lit(0).cast("bigint").alias("_new")).unionByName(
        table.select(*columns, F.lit(0).cast("bigint").alias("_old"), F.lit(1).cast("bigint").alias("_new")))
    sums = both.groupBy(*columns).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("copies"))
    sums.filter(F.col("_old") != F.col("copies")).drop("_old").write.mode("overwrite").parquet(f"{folder}/run={run}")


def intervals(log: DataFrame) -> DataFrame:
    """Rows with the runs `[from_run, to_run)` in which they held in that number; no `to_run` while they still do.

    A row's changes are its own few runs. A row that ends and comes back has several intervals.
    """
    columns = [c for c in log.columns if c not in MADE]
    following = F.lead("run").over(Window.partitionBy(*columns).orderBy("run"))
    return log.select(*columns, "copies", F.col("run").alias("from_run"), following.alias("to_run")).filter("copies > 0")


def rebuild(log: DataFrame, run: int) -> DataFrame:
    """The table as it was at a run, copies included."""
    held = state(log, run)
    columns = [c for c in held.columns if c != "copies"]
    return held.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("_copy")).drop("_copy")


def as_of(log: DataFrame, asked: DataFrame, keys: list[str], run: str) -> DataFrame:
    """For each asked key and run the rows that held then, copies as a number; no row where none did.

    An equality on the keys and a range on the runs: a key meets its own intervals only.
    """
    held = intervals(log)
    names = {k: f"_{i}" for i, k in enumerate(keys)}
    given = asked.select(*[F.col(k).alias(n) for k, n in names.items()], F.col(run).alias("_run"))
    on = F.lit(True)
    for key, name in names.items():
        on = on & F.col(key).eqNullSafe(F.col(name))
    inside = (F.col("from_run") <= F.col("_run")) & (F.col("to_run").isNull() | (F.col("_run") < F.col("to_run")))
    return given.join(held, on & inside).select(F.col("_run").alias("run"), *[c for c in held.columns if c not in ("from_run", "to_run")])

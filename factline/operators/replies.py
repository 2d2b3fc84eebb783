"""Replies of a model function, asked once for each request and remembered.

Replies are stored under the identity of the function and keyed by the hash of the request. A
run asks only for what is not stored, once for requests that are equal. Calls are dealt out in
small tasks of like cost, and each task's replies are in the store as soon as it ends, also when
another one fails: the run after it asks for the rest. At most the calls of a task under way are
made again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.functions.canonical import digest
from factline.operators.code import identity
from factline.operators.numbering import number_all
from factline.storage import keep

STORED = "request_hash string, reply string, run string"
CALLS_PER_TASK = 32


def store_of(folder: str, reply_to: Callable[[str], str]) -> str:
    """Where the replies of a function are: another function, or changed code, has another place."""
    return f"{folder.rstrip('/')}/{digest(identity(reply_to))}"


def stored(spark: SparkSession, store: str) -> DataFrame:
    """`(request_hash, reply, run)`, one row a request; empty where nothing is stored."""
    try:
        found = spark.read.schema(STORED).parquet(store)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], STORED)
    first = F.min_by(F.struct("reply", "run"), F.struct("run", "reply"))  # a task that ran twice leaves two
    return found.groupBy("request_hash").agg(first.alias("_first")).select("request_hash", "_first.reply", "_first.run")


def ask(requests: DataFrame, reply_to: Callable[[str], str], store: str, run: str = "", calls_per_task: int = CALLS_PER_TASK,
        threads: int = 4) -> None:
    """Ask for the replies of `request` texts that are not stored yet.

    `threads` calls are under way in a task at a time; the function must allow that.
    """
    spark = requests.sparkSession
    wanted = requests.filter(F.col("request").isNotNull()).select(F.sha2("request", 256).alias("request_hash"), "request").dropDuplicates(["request_hash"])
    missing = keep(wanted.join(stored(spark, store).select("request_hash"), "request_hash", "left_anti")
                   .withColumn("cost", F.length("request")), "requests")
    calls = missing.count()
    if not calls:
        return
    # By cost, then dealt out in turn: every task gets long and short requests alike.
    tasks = -(-calls // calls_per_task)
    dealt = number_all(missing, ["cost", "request_hash"], "turn").withColumn("task", F.pmod("turn", F.lit(tasks)).cast("int"))

    def answer(frames: Iterator) -> Iterator:
        with ThreadPoolExecutor(threads) as pool:
            for frame in frames:
                for start in range(0, len(frame), 4 * threads):
                    part = frame.iloc[start:start + 4 * threads]
                    yield part[["request_hash"]].assign(reply=list(pool.map(reply_to, part["request"])), run=run)

    asked = dealt.repartitionById(tasks, F.col("task")).select("request_hash", "request").mapInPandas(answer, STORED)
    # With this algorithm a task's file is in place when the task ends, not when the job does.
    asked.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(store)


def with_replies(requests: DataFrame, reply_to: Callable[[str], str], folder: str, run: str = "", calls_per_task: int = CALLS_PER_TASK,
                 threads: int = 4) -> DataFrame:
    """Add `reply` to requests, asking only for what the folder does not hold; a null request has none."""
    store = store_of(folder, reply_to)
    ask(requests, reply_to, store, run, calls_per_task, threads)
    held = stored(requests.sparkSession, store).select(F.col("request_hash").alias("_hash"), "reply")
    return requests.join(held, F.sha2("request", 256) == F.col("_hash"), "left").drop("_hash")

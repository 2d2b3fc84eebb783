"""Knowledge pages read as they arrive, in any order and any number of batches.

Each document is a small reader of its own: it knows which page it needs next, the chunk ids it
has seen and the totals declared so far, and keeps pages that came too early. When the page it
needs is there it reads on, by the rules of `operators.chunks.completeness`, until it stops. State
is held by key in Spark's state store, so a restart goes on where the last batch ended.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from factline.operators import chunks

STATUS = ("knowledge_id string, fetched_pages bigint, seen bigint, distinct_chunks bigint, total bigint, total_changed boolean, "
          "repeated boolean, complete boolean, warnings string, stopped boolean, given_up boolean")
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class PageReader(StatefulProcessor):
    """Reads one document's pages in order, whatever order they come in.

    A page that comes again is the same page and counts once. A document that has not stopped is
    given up at the first batch `quiet_ms` after its last page: its status is emitted once more,
    early pages and ids are let go, and later pages are ignored.
    """

    def __init__(self, quiet_ms: int | None = None):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState(
            "place", "page bigint, seen bigint, added bigint, total bigint, least bigint, most bigint, rows bigint, stop string, given_up boolean")
        self.ids = handle.getMapState("ids", "chunk_id string", "page bigint")
        self.early = handle.getMapState("early", "page bigint", "rows bigint, declared bigint, ids array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        place = self._place()
        if place["stop"] is not None or place["given_up"]:
            return
        came, when = {}, 0
        for frame in rows:
            if self.quiet_ms is not None:
                when = max(when, int(frame["came_ms"].max()))
            for page, n, declared, ids in zip(frame["page"], frame["rows"], frame["declared"], frame["ids"]):
                if page > place["page"]:
                    came[int(page)] = (int(n), None if pd.isna(declared) else int(declared), [str(i) for i in ids])
        before = place["page"]
        while place["stop"] is None:
            page = place["page"] + 1
            if page in came:
                found = came.pop(page)
                if self.early.exists() and self.early.containsKey((page,)):
                    self.early.removeKey((page,))
            elif self.early.exists() and self.early.containsKey((page,)):
                found = tuple(self.early.getValue((page,)))
                self.early.removeKey((page,))
            else:
                break
            self._read(place, page, *found)
        if place["stop"] is not None:
            self._let_go()
        else:
            for page, found in came.items():
                self.early.updateValue((page,), found)
            self._wait(when)
        self.place.update(tuple(place.values()))
        if place["page"] > before:
            yield self._status(key[0], place)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        place = self._place()
        if place["stop"] is None and not place["given_up"]:
            place["given_up"] = True
            self.place.update(tuple(place.values()))
            self._let_go()
            yield self._status(key[0], place)

    def close(self) -> None:
        pass

    def _place(self) -> dict:
        names = ["page", "seen", "added", "total", "least", "most", "rows", "stop", "given_up"]
        return dict(zip(names, self.place.get() if self.place.exists() else (0, 0, 0, None, None, None, 0, None, False)))

    def _read(self, place: dict, page: int, n: int, declared: int | None, ids: list[str]) -> None:
        if declared is not None:
            place["total"] = declared
            place["least"] = declared if place["least"] is None else min(place["least"], declared)
            place["most"] = declared if place["most"] is None else max(place["most"], declared)
        new = 0
        for chunk_id in dict.fromkeys(ids):
            if not self.ids.containsKey((chunk_id,)):
                self.ids.updateValue((chunk_id,), (page,))
                new += 1
        place["page"], place["rows"] = page, n
        place["seen"] += n
        place["added"] += new
        if n == 0 or place["total"] is not None and place["seen"] >= place["total"]:
            place["stop"] = "ended"
        elif new == 0:
            place["stop"] = "repeated"

    def _wait(self, when: int) -> None:
        if self.quiet_ms is None:
            return
        for due in list(self.handle.listTimers()):
            self.handle.deleteTimer(due)
        self.handle.registerTimer(when + self.quiet_ms)

    def _let_go(self) -> None:
        for state in (self.ids, self.early):
            state.clear()
        if self.quiet_ms is not None:
            for due in list(self.handle.listTimers()):
                self.handle.deleteTimer(due)

    def _status(self, knowledge_id: str, place: dict) -> pd.DataFrame:
        changed, repeated = place["least"] != place["most"], place["stop"] == "repeated"
        everything = place["rows"] == 0 if place["total"] is None else place["added"] == place["total"]
        whole = place["stop"] == "ended" and everything
        said = [chunks.TOTAL_CHANGED] * changed + [chunks.REPEATED] * repeated + [chunks.PARTIAL] * (not whole)
        row = (knowledge_id, place["page"], place["seen"], place["added"], place["total"], changed, repeated, not said, " ".join(said),
               place["stop"] is not None, place["given_up"])
        names = [part.strip().split(" ")[0] for part in STATUS.split(",")]
        return pd.DataFrame([row], columns=names).astype({"total": "Int64"})


def page_statuses(envelopes: DataFrame, quiet_ms: int | None = None) -> DataFrame:
    """The status of each document whenever a page of it is read, from a stream of envelopes.

    An envelope that breaks the response rules fails the stream. The last row of a document
    equals its row of `operators.chunks.completeness` over all pages that came, however they were
    dealt out; without page 1 there is none.
    """
    spark = envelopes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)  # the one that holds several states by key
    sound = chunks.checked(envelopes)
    narrow = sound.select(
        "knowledge_id", "page", F.size("data").cast("bigint").alias("rows"), F.when(F.col("total") >= 0, F.col("total")).alias("declared"),
        F.col("data.id").alias("ids"))
    if quiet_ms is not None:
        # The time of the batch is the event time: it only moves on, so no page is ever late.
        timed = narrow.withColumn("came", F.current_timestamp()).withWatermark("came", "0 seconds")
        narrow = timed.withColumn("came_ms", F.unix_millis("came"))
    return narrow.groupBy("knowledge_id").transformWithStateInPandas(
        PageReader(quiet_ms), STATUS, "Update", "None" if quiet_ms is None else "EventTime")


def follow_pages(spark: SparkSession, folder: str, progress: str, land: Callable[[DataFrame, int], None],
                 quiet_ms: int | None = None, files_per_batch: int | None = None) -> None:
    """Read the page files that have come since the last call and hand status rows to `land`, then stop.

    `land` gets a batch and its number; write under that number, so a batch repeated after a
    failure replaces itself.
    """
    reader = spark.readStream.schema(chunks.ENVELOPE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (page_statuses(reader.json(folder), quiet_ms).writeStream.outputMode("update").foreachBatch(land)
             .option("checkpointLocation", progress).trigger(availableNow=True).start())
    query.awaitTermination()


def land_in(folder: str) -> Callable[[DataFrame, int], None]:
    """Write each batch under its number."""

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return land


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The last status of each document that was landed."""
    landed = spark.read.option("basePath", folder).parquet(folder)
    kept = [c for c in landed.columns if c not in ("knowledge_id", "batch")]
    last = landed.groupBy("knowledge_id").agg(F.max_by(F.struct(*kept), F.struct("batch", "given_up", "fetched_pages")).alias("_last"))
    return last.select("knowledge_id", *[F.col("_last")[c].alias(c) for c in kept])

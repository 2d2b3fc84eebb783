"""Removal of lines that many documents share, with levelled sorted runs of line hashes.

Long lines are reduced to 128-bit hashes of their keys. Batches of hashes arrive one after
another. Runs are tables bucketed and sorted by hash, in levels: a new batch is merge-joined
with the runs; keys that no run holds (anti-join) become a run of their own at level 0, and
those seen before are noted as further finds. When a level has `fan_in` runs they are
compacted into one run of the next level, so each key is rewritten about log(batches) times.
At the end the runs and the finds give each key's number of documents and its largest doc_id.

Built-in expressions and joins only. A hot line is one row for each document until the
batch's map-side aggregation, and one row for each task after it.

Defined cases: a null or empty text is one empty line; each row counts as a document, also
where rows share an id or are repeated (rows that share the largest id all keep the line); a
null doc_id is lower than any other; an empty table gives an empty result; columns of the
input keep their names and order.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.functions.once import once
from factline.llm.names import set_aside, without
from factline.llm.words import SPACES, lowered
from factline.storage import fresh_path, keep

KEY = ["line_hash"]


def line_key(line: Column) -> Column:
    """A line without outer white space, A-Z in lower case."""
    return lowered(F.btrim(line, F.lit(SPACES)))


class LineRuns:
    """Line hashes seen so far, as levelled sorted runs."""

    def __init__(self, spark: SparkSession, fan_in: int = 3):
        self._spark, self._fan_in = spark, fan_in
        self._buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._levels: list[list[str]] = []
        self._finds: list[DataFrame] = []
        self._names: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid4().hex}"
        (rows.repartition(self._buckets, *KEY).write.format("parquet").bucketBy(self._buckets, *KEY).sortBy(*KEY)
         .option("path", fresh_path(self._spark, "line-run")).saveAsTable(name))
        self._names.append(name)
        return name

    def _stored(self) -> DataFrame | None:
        runs = [self._spark.table(name) for level in self._levels for name in level]
        whole = runs[0] if runs else None
        for run in runs[1:]:
            whole = whole.unionByName(run)
        return whole

    def add(self, finds: DataFrame) -> None:
        """Add a batch of (line_hash, doc_id), one row for each line key of a document."""
        batch = finds.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        seen = self._stored()
        if seen is not None:
            batch = keep(batch, "line-batch")
            again = batch.join(seen.select(*KEY).hint("merge"), KEY, "left_semi")
            self._finds.append(keep(again, "line-finds"))
            batch = batch.join(seen.select(*KEY).hint("merge"), KEY, "left_anti")
        if not self._levels:
            self._levels.append([])
        self._levels[0].append(self._write(batch))
        self._compact()

    def _compact(self) -> None:
        for at, level in enumerate(self._levels):
            if len(level) >= self._fan_in:
                whole = self._spark.table(level[0])
                for name in level[1:]:
                    whole = whole.unionByName(self._spark.table(name))
                if at + 1 == len(self._levels):
                    self._levels.append([])
                self._levels[at + 1].append(self._write(whole))
                self._levels[at] = []

    def repeated(self, min_docs: int) -> DataFrame:
        """Keys found in at least so many documents, with the largest id: (line_hash, n_docs, keeper)."""
        whole = self._stored()
        for finds in self._finds:
            whole = whole.unionByName(finds)
        found = whole.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))
        return keep(found.filter(F.col("n_docs") >= min_docs), "line-repeats")

    def close(self) -> None:
        """Forget the run tables."""
        for name in self._names:
            self._spark.sql(f"DROP TABLE IF EXISTS {name}")


def dropped_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 6, fan_in: int = 3) -> DataFrame:
    """The lines that go: (doc_id, tie, places), one row for each document that loses any.

    `tie` is a hash of the text, `places` are ascending. Lines are hashed in one pass over the
    texts and stored; batches are taken from that table.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    keyed = once(docs.select("doc_id", text.alias("text")), keys=F.filter(
        F.transform(F.split("text", "\n"), lambda line, place: F.struct(place.alias("place"), line_key(line).alias("key"))),
        lambda line: F.length(line["key"]) >= min_chars)).filter(F.size("keys") > 0)
    lines = keep(keyed.select(
        "doc_id", F.xxhash64("text").alias("tie"), F.pmod(F.spark_partition_id(), F.lit(batches)).alias("batch"),
        F.transform("keys", lambda line: F.struct(line["place"].alias("place"), F.md5(line["key"]).alias("line_hash"))).alias("lines"),
    ), "lines")

    runs = LineRuns(spark, fan_in)
    for batch in range(batches):
        runs.add(lines.filter(F.col("batch") == batch).select(
            "doc_id", F.explode(F.array_distinct("lines.line_hash")).alias("line_hash")))
    repeated = runs.repeated(min_docs)
    runs.close()

    return (lines.select("doc_id", "tie", F.inline("lines")).join(repeated.select("line_hash", "keeper"), "line_hash")
            .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "tie").agg(F.array_sort(F.collect_set("place")).alias("places")))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 6, fan_in: int = 3) -> DataFrame:
    """The documents with their remaining lines as `text`, and `n_lines` and `n_dropped` added (in place of such columns).

    A line goes if its key has at least `min_chars` code points and is found in at least
    `min_docs` documents, unless the document has the largest doc_id that holds it.
    """
    whole = without(docs, ("n_lines", "n_dropped"))
    docs, columns = set_aside(whole, "doc_id", "text")
    others = [column for c, column in zip(whole.columns, columns) if c != "text"]
    kept = [c for c in docs.columns if c != "text"]
    gone = dropped_lines(docs, min_chars, min_docs, batches, fan_in)
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), F.col("places").alias("_places"))
    whole = docs.select(*kept, F.coalesce("text", F.lit("")).alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    joined = whole.join(gone, whole["doc_id"].eqNullSafe(gone["_id"]) & (whole["_hash"] == gone["_tie"]), "left")
    split = once(joined, _lines=F.split("_text", "\n"))
    split = split.withColumn("_n", F.size("_lines"))
    # The lines between one dropped place and the next, so that no line is looked up among the dropped ones.
    stretch = F.flatten(F.transform(
        F.sequence(F.lit(0), F.size("_places")),
        lambda i: F.slice(
            "_lines", F.when(i == 0, 1).otherwise(F.get("_places", i - 1) + 2),
            F.coalesce(F.get("_places", i), F.col("_n")) - F.when(i == 0, 0).otherwise(F.get("_places", i - 1) + 1))))
    made = split.withColumns({
        "text": F.when(F.col("_places").isNull(), F.col("_text")).otherwise(F.array_join(stretch, "\n")),
        "n_lines": F.col("_n").cast("long"),
        "n_dropped": F.when(F.col("_places").isNull(), 0).otherwise(F.size("_places")).cast("long")})
    return made.select(*others, "text", "n_lines", "n_dropped")

"""Mixing sources to target weights by entropy balancing.

Targets: sources, in code point order with null last, have weights that repeat, and share
all words by weight; a target stops at `most` times its source's words and the excess is
shared again. Rates: among all rates that meet each source's target, those that stay nearest
to 1 in relative entropy over words are exponential tilts exp(lambda) of the documents; the
lambdas are the minimum of a convex dual (for each source, words * exp(lambda) - target *
lambda), which Newton iterations over the table of sources find. Copies: a rate's whole part
is taken from each document, its rest from some of them. Documents are put in classes of
nearly equal size; from the largest class down, each class takes as many further documents
as its source still owes, and passes on what is left. Inside a class they are spread over
4,096 slots by a hash of the id, so no class is gathered in one task.

Built-in expressions only. What is kept for a source, class or slot are counts, summed before
they are shuffled; only scalars come to the driver.

Defined cases: a null size counts as 0 and a document of size 0 is taken 0 words (its copies
follow the same rule); repeated rows are documents of their own; equal ids are ordered by
size; with no words at all every target is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factline.llm.names import set_aside, without
from factline.operators.numbering import part_of, place, position_of, with_place
from factline.storage import fresh_path, keep

SLOTS = 4_096
#: Sizes are classed by their leading binary digits; smaller sizes have classes of their own.
DIGITS = 7


def _ranked(sources: DataFrame) -> DataFrame:
    """Number the sources from 0 in code point order, null last."""
    spark = sources.sparkSession
    path = fresh_path(spark, "sources")
    flagged = sources.withColumn("_null", F.col("source").isNull())
    place(flagged, ["_null", "source"], path)
    stored = spark.read.schema(with_place(flagged.schema)).parquet(path).withColumn("_part", part_of(F.col("_at")))
    counts = sorted((r["_part"], r["n"]) for r in stored.groupBy("_part").agg(F.count("*").alias("n")).collect())  # one row a partition
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts, "_part long, _start long")
    return stored.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_start") + position_of(F.col("_at"))).select(
        *sources.columns, "rank")


def targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3) -> DataFrame:
    """Add `target` to a table of (source, source_size), one row a source."""
    share = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))).cast("int"))
    ranked = _ranked(sources).withColumn("_weight", share).withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    ranked = keep(ranked.withColumn("_stop", F.col("_cap") / F.col("_weight")), "source-weights")  # the level at which it is full
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, before = 0.0, -1
    while True:
        full = F.col("_stop") < level
        n, capped, weight = ranked.agg(F.count_if(full), F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_weight")))).first()
        if n == before or not weight:
            break
        before, level = n, (total - (capped or 0.0)) / weight
    return ranked.select("source", "source_size", F.least(F.col("_weight") * F.lit(level), F.col("_cap")).alias("target"))


def tilts(sources: DataFrame, precision: float = 1e-12, at_most: int = 100) -> DataFrame:
    """Add `tilt`, the lambda that minimises the dual for (source_size, target), by Newton steps from 0.

    A step needs each source's gradient, words * exp(tilt) - target, and curvature, words *
    exp(tilt); all documents of a source are tilted alike, so its words stand for their sum.
    """
    words = F.col("source_size").cast("double")
    state = keep(sources.withColumn("tilt", F.lit(0.0)), "tilts")
    for _ in range(at_most):
        gradient, curvature = words * F.exp("tilt") - F.col("target"), words * F.exp("tilt")
        off = state.agg(F.max(F.when(F.col("target") > 0, F.abs(gradient) / F.col("target")))).first()[0]
        if off is None or off <= precision:
            break
        state = keep(state.withColumn("tilt", F.when(F.col("target") > 0, F.col("tilt") - gradient / curvature).otherwise(0.0)), "tilts")
    return state


_GROUP = ["_null", "_name", "_class", "_slot"]


def _classed(docs: DataFrame, size: str) -> DataFrame:
    """Add each document's words, lot, source key, size class and slot."""
    cut = f"greatest(length(bin(_words)) - {DIGITS}, 0)"
    return docs.withColumns({
        "_words": F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long")),
        "_lot": F.xxhash64("doc_id"), "_null": F.col("source").isNull(), "_name": F.coalesce("source", F.lit("")),
    }).withColumns({"_class": F.expr(f"shiftleft(shiftright(_words, {cut}), {cut})"), "_slot": F.pmod("_lot", F.lit(SLOTS))})


def _further(counted: DataFrame, rates: DataFrame) -> DataFrame:
    """How many documents of each slot are taken once more: (group, _more)."""
    classes = counted.groupBy("_null", "_name", "_class").agg(F.sum("_n").alias("n"), F.sum("_sum").alias("words"))
    lists = classes.groupBy("_null", "_name").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_class").alias("size"), "n", "words")), asc=False).alias("classes"))
    lists = lists.join(rates.select("_null", "_name", "_rest"), ["_null", "_name"])
    # From the largest class down: take what is owed in whole documents, pass the rest on.
    nothing = F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<struct<size:bigint,n:bigint,more:bigint>>").alias("taken"))

    def take(state, one):
        owed = state["owed"] + F.col("_rest") * one["words"]
        mean = F.greatest(one["words"] / one["n"], F.lit(1e-9))
        more = F.least(F.greatest(F.round(owed / mean), F.lit(0.0)), one["n"].cast("double")).cast("long")
        return F.struct((owed - more * one["words"] / one["n"]).alias("owed"), F.concat(state["taken"], F.array(
            F.struct(one["size"].alias("size"), one["n"].alias("n"), more.alias("more")))).alias("taken"))

    taken = lists.select("_null", "_name", F.explode(F.aggregate("classes", nothing, take)["taken"]).alias("one"))
    taken = taken.select("_null", "_name", F.col("one.size").alias("_class"), F.col("one.n").alias("_of"), F.col("one.more").alias("_take"))
    upto = Window.partitionBy("_null", "_name", "_class").orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slots = counted.withColumn("_upto", F.sum("_n").over(upto)).join(taken, ["_null", "_name", "_class"])  # SLOTS rows a class at most
    share = lambda n: F.floor(F.col("_take") * n / F.col("_of") + 0.5)
    return slots.select(*_GROUP, (share(F.col("_upto")) - share(F.col("_upto") - F.col("_n"))).alias("_more"))


def mix(docs: DataFrame, size: str = "size", weights: tuple[float, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Add `source_size`, `target`, `rate` and `copies` to documents with a source and a size.

    `copies` is the rate rounded down or up, so at most `most`. Give it stored columns, as
    they are read twice; columns of the input keep their names and order, but for those named
    like an added one, which are replaced.
    """
    docs, columns = set_aside(without(docs, ("source_size", "target", "rate", "copies")), *dict.fromkeys(("doc_id", "source", size)))
    placed = _classed(docs, size)
    counted = keep(placed.groupBy(*_GROUP).agg(F.count("*").alias("_n"), F.sum("_words").alias("_sum")), "slots")
    sources = counted.groupBy("_null", "_name").agg(F.sum("_sum").alias("source_size"))
    sources = sources.select(F.when(~F.col("_null"), F.col("_name")).alias("source"), "source_size")
    rates = tilts(targets(sources, weights, most)).select(
        F.col("source").isNull().alias("_null"), F.coalesce("source", F.lit("")).alias("_name"), "source_size", "target",
        F.when(F.col("target") > 0, F.least(F.exp("tilt"), F.lit(float(most)))).otherwise(0.0).alias("rate"))
    rates = rates.withColumn("_whole", F.floor(F.col("rate") + 1e-9)).withColumn(
        "_rest", F.greatest(F.col("rate") - F.col("_whole"), F.lit(0.0)))
    plan = _further(counted, rates).join(rates, ["_null", "_name"])
    turn = F.row_number().over(Window.partitionBy(*_GROUP).orderBy("_lot", "doc_id", "_words"))
    return placed.join(plan, _GROUP).select(
        *columns, "source_size", "target", "rate",
        (F.col("_whole") + F.when(turn <= F.col("_more"), 1).otherwise(0)).cast("int").alias("copies"))

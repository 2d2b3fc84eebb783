"""What was made of what: stored edges between inputs, operations and tables, and their closure.

An edge `(source, target)` says that the target was made with the source. Edges are appended by
operation, as files of their own, so writers do not touch each other's and a retry replaces itself.

Nodes are any non-empty text. Edges with a null end are none, repeated edges count once, and a node
that leads back to itself ends nothing and repeats nothing: every node is reached once for each start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factline.storage import fresh_path, keep

EDGES = "source string, target string"
REACHED = "start string, node string, distance bigint"
SEGMENT = 1024  # nodes of a chain that are filled in together


def record(edges: DataFrame, folder: str, operation: str) -> None:
    """Append the edges of one operation; recorded again, they replace those of the first time."""
    edges.select("source", "target").write.mode("overwrite").parquet(f"{folder}/operation={operation}")


def recorded(spark: SparkSession, folder: str) -> DataFrame:
    """All edges recorded so far; empty before the first."""
    try:
        return spark.read.schema(EDGES).option("basePath", folder).parquet(folder).select("source", "target")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], EDGES)


def _number(name: Column, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), name)


def _numbered(names: DataFrame) -> tuple[DataFrame, int]:
    """The different names as `(id, name)`, and the salt of a hash that gives each its own id."""
    names, salt = keep(names.distinct(), "lineage-names"), 0
    while not names.groupBy(_number(names["name"], salt).alias("id")).count().filter("count > 1").isEmpty():
        salt += 1
    return names.select(_number(names["name"], salt).alias("id"), "name"), salt


def _ranked(links: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """The last node of every node's chain and the number of edges to it, as `(node, tail, hops)`; nodes in rings.

    `links` are pairs `(node, next)`, each node at most once on either side, so they form chains and rings. Each
    round doubles the way that a row has looked ahead. While a chain is not done, each round ends some row of it;
    rows left when none ended are those of rings. The last nodes themselves have no row.
    """
    spark = links.sparkSession

    def stored(rows: str) -> DataFrame:
        return (spark.read.schema("node bigint, tail bigint, hops bigint, round int, open boolean")
                .option("basePath", folder).parquet(folder).filter(rows).drop("round"))

    def store(rows: DataFrame, turn: int) -> None:
        rows.write.partitionBy("open").parquet(f"{folder}/round={turn}")

    store(links.select("node", F.col("next").alias("tail"), F.lit(1).cast("bigint").alias("hops"), F.lit(True).alias("open")), 0)
    turn, before, left = 0, None, stored("open").count()
    while left and left != before:
        ahead = stored(f"NOT open OR round = {turn}").toDF("tail", "_tail", "_hops", "_open")
        store(stored(f"open AND round = {turn}").drop("open").join(ahead, "tail", "left").select(
            "node", F.coalesce("_tail", "tail").alias("tail"), (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"),
            F.coalesce("_open", F.lit(False)).alias("open")), turn + 1)
        turn += 1
        before, left = left, stored(f"open AND round = {turn}").count()
    return stored("NOT open").drop("open"), stored(f"open AND round = {turn}").select("node")


def reach(edges: DataFrame, starts: DataFrame, up: bool = False) -> DataFrame:
    """Every `(start, node, distance)` where the node rests on the start, over any number of edges.

    `starts` has the column `node`; `up` follows edges from targets to sources instead. The distance is
    the least number of edges; a start is not among its own nodes. Both tables are read several times. Names go by
    64-bit hashes until the end; were two to have the same one, another hash would be taken.

    Nodes with one edge onwards form chains (a node that several of them lead to goes on the chain of one). Where a
    chain is entered is found round by round: a round follows the edges of the chain ends and branching nodes that
    the round before reached or reached by a shorter way, keeps what is new or nearer, and is stored, so a lost
    executor repeats one round and the plan stays short. The nodes between are then filled in at once: a node's
    distance is the least over the entries before it. Rounds are as many as the shortest ways have edges outside
    of chains, and one more for each `SEGMENT` nodes of a chain; chains are ranked in as many as the logarithm of their length.
    """
    spark = edges.sparkSession
    here, there = ("target", "source") if up else ("source", "target")
    edges = edges.select(F.col(here).alias("_from"), F.col(there).alias("_to")).filter("_from IS NOT NULL AND _to IS NOT NULL")
    starts = starts.select(F.col("node").alias("name")).filter("name IS NOT NULL").distinct()
    names, salt = _numbered(
        edges.select(F.col("_from").alias("name")).unionByName(edges.select(F.col("_to").alias("name"))).unionByName(starts))
    begun = keep(starts.select(_number(F.col("name"), salt).alias("start"), "name"), "lineage-starts")
    steps = keep(
        edges.select(_number(F.col("_from"), salt).alias("_from"), _number(F.col("_to"), salt).alias("_to")).filter("_from <> _to"),
        "lineage-edges")

    onwards = keep(steps.groupBy("_from").agg(F.min("_to").alias("next"), F.max("_to").alias("_last")), "lineage-onwards")
    single = onwards.filter("next = _last").select(F.col("_from").alias("node"), "next")
    taken = keep(single.groupBy("next").agg(F.min("node").alias("node"), F.max("node").alias("_other")), "lineage-links")
    merged = keep(taken.filter("node <> _other").select("next", F.col("node").alias("_taken")), "lineage-merged")
    ranks, rings = _ranked(taken, fresh_path(spark, "lineage-ranks"))
    cuts = keep(ranks.filter(f"hops % {SEGMENT} = 0").select(
        F.col("node").alias("_cut"), F.col("tail").alias("_tail"), F.col("hops").alias("_hops")), "lineage-cuts")
    # Every node with the last node of its segment, itself outside of chains, and the edges left to that.
    nodes = keep(
        names.join(ranks.withColumnRenamed("node", "id"), "id", "left")
        .join(cuts, F.expr(f"tail = _tail AND hops - hops % {SEGMENT} = _hops"), "left").select(
            F.col("id").alias("node"), "name", F.coalesce("_cut", "tail", "id").alias("segment"),
            F.expr(f"coalesce(hops, 0) % {SEGMENT}").alias("_left")), "lineage-nodes")

    # The nodes whose edges are followed one by one: all that have edges and are not inside a segment of a chain.
    opens = keep(
        onwards.filter("next <> _last").select(F.col("_from").alias("node"))
        .unionByName(single.join(merged, "next").filter("node <> _taken").select("node"))
        .unionByName(rings).unionByName(cuts.select(F.col("_cut").alias("node"))), "lineage-opens")
    ways = keep(
        nodes.filter("_left > 0").select("node", "segment", "_left").join(opens.toDF("segment"), "segment", "left_semi"), "lineage-ways")
    no_ways = ways.isEmpty()

    folder = fresh_path(spark, "lineage")
    entries = "start bigint, node bigint, distance bigint"

    def stored() -> DataFrame:
        return spark.read.schema(entries).option("basePath", folder).parquet(folder).drop("round")

    def store(found: DataFrame, turn: int) -> DataFrame:
        """Store what a round entered, and the ends of the segments entered; the nodes among them to go on from."""
        if not no_ways:
            found = found.join(ways, "node", "left").select("start", F.inline(F.filter(F.array(
                F.struct("node", "distance"), F.struct(F.col("segment").alias("node"), (F.col("distance") + F.col("_left")).alias("distance"))),
                lambda entry: entry["node"].isNotNull())))
        found = found.groupBy("node", "start").agg(F.min("distance").alias("distance")).select("start", "node", "distance")
        if turn:
            known = stored().toDF("_start", "_node", "_distance")
            found = found.join(known, F.expr("node = _node AND start = _start AND _distance <= distance"), "left_anti")
        path = f"{folder}/round={turn}"
        found.write.parquet(path)
        return spark.read.schema(entries).parquet(path).join(opens, "node", "left_semi")

    latest, turn = store(begun.select("start", F.col("start").alias("node"), F.lit(0).cast("bigint").alias("distance")), 0), 0
    while not latest.isEmpty():
        turn += 1
        latest = store(latest.join(steps, F.col("node") == F.col("_from")).select(
            "start", F.col("_to").alias("node"), (F.col("distance") + 1).alias("distance")), turn)

    # Entries in the order of their segment. A node can have two, of which the nearer one comes first.
    along = Window.partitionBy("segment", "start").orderBy(F.desc("_left"), "distance")
    placed = keep(
        stored().join(nodes, "node").select(
            "start", "name", "segment", "_left",
            F.min(F.col("distance") + F.col("_left")).over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("_whole"),
            F.lag("_left").over(along).alias("_before"), F.lead("_left", 1, -1).over(along).alias("_next")), "lineage-placed")
    entered = placed.filter("_before IS NULL OR _before <> _left").select("start", F.col("name").alias("node"), "_whole", "_left")
    between = placed.filter("_left - _next > 1").select(
        "start", "segment", "_whole", F.explode(F.sequence(F.col("_next") + 1, F.col("_left") - 1)).alias("_left"))
    passed = between.join(nodes, ["segment", "_left"]).select("start", F.col("name").alias("node"), "_whole", "_left")
    return entered.unionByName(passed).filter("_whole > _left").join(begun, "start").select(
        F.col("name").alias("start"), "node", (F.col("_whole") - F.col("_left")).alias("distance"))

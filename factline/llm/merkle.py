"""Merkle manifest of a table: a tree of digests a source, a tree over the sources, and proofs.

Each level is one equijoin of the nodes with themselves: the slot-zero node of every run
computes the indices of its siblings (index XOR 1 in binary trees, index + 1 .. arity - 1
otherwise) and meets them by tree and index; the run's digests, at most `arity`, then give its
parent. Indices are unique, so no key is hot however large a source is. A tree ends at the
level where its first run holds one node.

Proofs go down the same runs: a run hands each child what stands left and right of it, before
what the run itself got from above. At the leaves one row a run carries the siblings of all
levels, and its documents are folded up in that row without another shuffle.

Defined cases: a null field counts as `-`. A null source is a tree of its own, before all
others. Leaves of one source are ordered by id, a null id first, then by leaf; rows that are
equal in all fields have equal leaves and take neighbouring places. A null id is never
tampered with. An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.llm.words import lowered
from factline.operators.numbering import number_all, number_within
from factline.storage import keep

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A field as the leaf takes it: `-` for null, else its UTF-8 byte count, a colon and itself."""
    word = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(word).cast("string"), F.lit(":"), word), F.lit("-"))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """The leaf of a row with these fields."""
    return digest(F.concat(*[field(value) for value in values]))


def sibling_indices(at: Column, arity: int) -> list[Column]:
    """Where the siblings of a slot-zero node stand."""
    return [at.bitwiseXOR(F.lit(1).cast("long"))] if arity == 2 else [at + k for k in range(1, arity)]


def runs_of(nodes: DataFrame, arity: int) -> DataFrame:
    """Rows `(tree, parent, members)` of nodes `(tree, at, hash, load)`; members are `(at, hash, load)` in order."""
    zero = nodes.filter(F.col("at") % arity == 0).select(
        F.col("tree").alias("_tree"), (F.col("at") / arity).cast("long").alias("parent"),
        F.explode(F.array("at", *sibling_indices(F.col("at"), arity))).alias("_at"))
    met = zero.join(nodes, F.col("_tree").eqNullSafe(F.col("tree")) & (F.col("_at") == F.col("at")))
    return met.groupBy("tree", "parent").agg(F.array_sort(F.collect_list(F.struct("at", "hash", "load"))).alias("members"))


def joined(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def grow(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels of the trees of `(tree, at, hash, load)`: stored runs level by level, and the roots `(tree, level, hash)`.

    A level's runs are those of trees that end there and of trees that go on.
    """
    levels, roots, level = [], None, 0
    while True:
        runs = keep(runs_of(nodes, arity), "runs").withColumn("ends", (F.col("parent") == 0) & (F.size("members") == 1))
        levels.append(runs)
        ended = runs.filter("ends").select("tree", F.lit(level).alias("level"), F.col("members")[0]["hash"].alias("hash"))
        roots = ended if roots is None else roots.unionByName(ended)
        if runs.filter("not ends").isEmpty():
            return levels, roots
        nodes = runs.filter("not ends").select(
            "tree", F.col("parent").alias("at"), digest(joined(F.col("members.hash"))).alias("hash"), F.lit(None).cast("long").alias("load"))
        level += 1


def beside(members: Column, place: Column) -> Column:
    """What stands left and right of a member, as one step of its path."""
    hashes = F.transform(members, lambda member: member["hash"])
    return F.struct(joined(F.slice(hashes, F.lit(1), place)).alias("left"),
                    joined(F.slice(hashes, place + 2, F.size(members))).alias("right"))


def with_paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaf runs `(tree, members, ends, path, top)` with the path from the run's parent up.

    `tops`: `(tree, path, top)`, what stands above the root of each tree and what to hand down.
    """
    above = None
    for level in range(len(levels) - 1, -1, -1):
        runs = levels[level]
        heads = tops.select(F.col("tree").alias("_tree"), "path", "top")
        met = runs.filter("ends").join(heads, F.col("tree").eqNullSafe(F.col("_tree"))).select("tree", "parent", "members", "ends", "path", "top")
        if above is not None:
            on = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("parent") == F.col("_at"))
            met = met.unionByName(runs.filter("not ends").join(above, on).select("tree", "parent", "members", "ends", "path", "top"))
        if level == 0:
            return met
        each = met.select("tree", "ends", "path", "top", "members", F.posexplode("members").alias("place", "member"))
        above = keep(each.select(
            F.col("tree").alias("_tree"), F.col("member.at").alias("_at"),
            F.when(F.col("ends"), F.col("path")).otherwise(
                F.concat(F.array(beside(F.col("members"), F.col("place"))), F.col("path"))).cast(_PATH).alias("path"), "top"), "paths")


def fold(start: Column, path: Column) -> Column:
    """The digest at the end of a path."""
    return F.aggregate(path, start, lambda got, step: digest(F.concat(step["left"], got, step["right"])))


def proof(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return joined(F.transform(path, lambda step: F.concat(step["left"], step["right"])))


def manifest(leaves: DataFrame, arity: int = ARITY) -> DataFrame:
    """`(tree, at, hash, load, subroot, root, path)` for leaves `(tree, order, hash, load)`.

    Leaves are ordered within their tree by (order, hash); trees are ordered by name, null
    first. `path` holds what stands left and right at each level from the leaf to the root.
    """
    tree = number_within(leaves, ["tree"], ["order", "hash"], start=0, name="at").select("tree", "at", "hash", "load")
    levels, roots = grow(tree, arity)
    named = number_all(keep(roots.select("tree", "hash"), "roots"), ["tree"], "at")
    upper, ends = grow(named.select(F.lit(0).alias("tree"), "at", "hash", F.col("tree").alias("load")), arity)
    crown = ends.select("tree", F.array().cast(_PATH).alias("path"), F.col("hash").alias("top"))
    spread = with_paths(upper, crown).select("ends", "path", "top", "members", F.posexplode("members").alias("place", "member"))
    tops = keep(spread.select(
        F.col("member.load").alias("tree"), _extended().alias("path"),
        F.struct(F.col("member.hash").alias("subroot"), F.col("top").alias("root")).alias("top")), "tops")
    rows = with_paths(levels, tops).select("tree", "ends", "path", "top", "members", F.posexplode("members").alias("place", "member"))
    return rows.select("tree", F.col("member.at").alias("at"), F.col("member.hash").alias("hash"), F.col("member.load").alias("load"),
                       "top.subroot", "top.root", _extended().alias("path"))


def _extended() -> Column:
    """The path of a member of a run; a run that ends its tree adds nothing."""
    own = F.array(beside(F.col("members"), F.col("place")))
    return F.when(F.col("ends"), F.col("path")).otherwise(F.concat(own, F.col("path"))).cast(_PATH)


def leaves_of(docs: DataFrame) -> DataFrame:
    """Leaves of documents; `load` holds the id, and the leaf of the tampered text where it is tampered with."""
    values = {name: F.col(name) for name in FIELDS}
    hit = F.crc32(values["doc_id"].cast("string").cast("binary")) % 5 == 0
    other = leaf(*[lowered(value) if name == "text" else value for name, value in values.items()])
    return docs.select(values["source"].alias("tree"), values["doc_id"].alias("order"), leaf(*values.values()).alias("hash"),
                       F.struct(values["doc_id"].alias("doc_id"), F.when(hit, other).alias("tampered")).alias("load"))


def verified(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """One row per document: its leaf, roots and proof, and whether what it is now folds up to the root."""
    rows = manifest(keep(leaves_of(docs), "leaves"), arity)  # stored: ordering them reads them twice
    folded = rows.select(F.col("load.doc_id").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", "root",
                         digest(proof(F.col("path"))).alias("proof_sha256"),
                         fold(F.coalesce("load.tampered", "hash"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))

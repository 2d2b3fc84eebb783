"""Near-duplicate groups by SimHash fingerprints and the generalised pigeonhole principle.

A document's fingerprint has a bit set where more than half of its shingle hashes have it;
it has one or more lanes of 64 bits, from differently mixed hashes. Equal fingerprints are folded first. The 64 bits of the first lane are dealt into partitions so that correlated
bits lie together. If two fingerprints differ in at most `radius` bits, then for thresholds
that add up to radius - partitions + 1 they differ in at most its threshold in some
partition. Dynamic programming picks the thresholds (-1: not probed) with the least rows to
probe and candidates to check, estimated from a bounded sample of fingerprints. Fingerprints
meet in buckets, one for each partition and probed value, where all of them are compared on
all bits: they link if the first lane differs in at most `radius` bits and all lanes in at
most `total`. A bucket emits a spanning forest of its links, never all pairs, which keeps
every component whole; a bucket over `LIMIT` rows is compared as pairs of blocks in tasks of
their own. Components then join the forests. The near-copy stage takes such components of
several lanes as candidates only, and compares their shingle sets.

Defined cases: a null or empty text has fingerprint zero and links like any other; a text
with fewer words than a shingle is one shingle; repeated rows have one fingerprint and one
component; a null doc_id takes part but is no component's name unless it is alone; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factline.llm.arrow import blocks
from factline.llm.graph import components
from factline.llm.names import quoted, set_aside, unused, without
from factline.llm.recurring import mixed
from factline.storage import keep

BITS = 64
SEED = 42
#: Fingerprints that the estimates are made from, and rows of a bucket that one task compares.
SAMPLE, LIMIT = 4_096, 4_096
#: A probed row costs as much as this many comparisons.
ROW_COST = 500
#: Shingles of a group that one task compares, and a set's least shingles that tell whether it may have a near copy.
MOST_SHINGLES, LEAST = 1 << 20, 16


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """The hashes of the shingles of a UTF-8 text, in its order."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the word rule's white space
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x, SEED) for x in shingles), np.uint64)


def printed(hashes: np.ndarray, lanes: int) -> list[int]:
    """The fingerprint of shingle hashes, as signed 64-bit integers."""
    found = []
    for lane in range(lanes):
        totals = np.zeros(BITS, np.int64)
        for at in range(0, len(hashes), 8_192):
            part = hashes[at:at + 8_192]
            part = (mixed(part + np.uint64(lane)) if lane else part).astype(">u8").view(np.uint8).reshape(-1, 8)
            totals += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        found.append(int.from_bytes(np.packbits(2 * totals > len(hashes)).tobytes(), "big", signed=True))
    return found


def fingerprint(text: bytes, shingle: int, lanes: int = 1) -> list[int]:
    """The fingerprint of a UTF-8 text, as signed 64-bit integers."""
    return printed(shingle_hashes(text, shingle), lanes)


def lane_names(lanes: int) -> list[str]:
    return ["fp", *[f"fp{lane}" for lane in range(2, lanes + 1)]]


def fingerprints(docs: DataFrame, shingle: int = 3, lanes: int = 1) -> DataFrame:
    """The columns of `docs` without `text`, and the lanes `fp`, `fp2`, ... (long)."""
    made = lane_names(lanes)
    whole = without(docs, made)
    texts, columns = set_aside(whole, "text")
    others, name = [c for c in texts.columns if c != "text"], unused([*texts.columns, *made], "raw")
    schema = T.StructType([*[texts.schema[c] for c in others], *[T.StructField(c, T.LongType(), False) for c in made]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, name):
            found = np.array([fingerprint(x, shingle, lanes) for x in block.column(name).to_pylist()], np.int64).T
            yield pa.record_batch([*[block.column(c) for c in others], *map(pa.array, found)], [*others, *made])

    raw = F.coalesce("text", F.lit("")).cast("binary").alias(name)
    kept = [column for c, column in zip(whole.columns, columns) if c != "text"]
    return texts.select(*others, raw).mapInArrow(run, schema).select(*kept, *made)


def _bits(values: np.ndarray) -> np.ndarray:
    """A row of 64 signs for each value, the bit of weight 2**i in column i."""
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32) * 2 - 1


def correlations(distinct: DataFrame) -> np.ndarray:
    """How far each two bits agree over all fingerprints, from one 64 x 64 sum a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            signs = _bits(np.asarray(batch.column("fp")))
            total += signs.T @ signs
        yield pa.record_batch([pa.array(range(BITS * BITS), pa.int32()), pa.array(total.ravel())], ["cell", "agree"])

    sums = distinct.select("fp").mapInArrow(run, "cell int, agree double").groupBy("cell").agg(F.sum("agree").alias("agree"))
    matrix = np.zeros(BITS * BITS)
    for row in sums.collect():  # 4,096 cells
        matrix[row["cell"]] = row["agree"]
    return np.abs(matrix.reshape(BITS, BITS)) / max(1.0, matrix.max(initial=1.0))


def partitions(agree: np.ndarray, count: int) -> list[list[int]]:
    """Deal the bits into `count` parts of nearly equal size, each grown by the bit that agrees most with it."""
    left, parts = list(range(BITS)), []
    off = agree - np.diag(np.diag(agree))
    for size in [BITS // count + (i < BITS % count) for i in range(count)]:
        within = off[np.ix_(left, left)]
        part = [left[int(within.max(axis=1).argmax())]]
        while len(part) < size:
            rest = [bit for bit in left if bit not in part]
            part.append(max(rest, key=lambda bit: (off[bit, part].sum(), -bit)))
        left = [bit for bit in left if bit not in part]
        parts.append(sorted(part))
    return parts


def mask_of(bits: Iterable[int]) -> int:
    return sum(1 << bit for bit in bits)


def flips(bits: list[int], radius: int) -> list[int]:
    """Masks of at most so many of the bits."""
    return [mask_of(some) for k in range(radius + 1) for some in combinations(bits, k)]


def halves(threshold: int) -> tuple[int, int]:
    """How many bits the probing and the stored side of a bucket flip to meet within a threshold."""
    return threshold - threshold // 2, threshold // 2


def allocate(parts: list[list[int]], radius: int, sample: np.ndarray, n: int) -> tuple[list[int], float]:
    """Thresholds by dynamic programming on estimated cost, and that cost."""
    options = []  # by partition: cost by threshold from -1
    for part in parts:
        own = sample & np.uint64(mask_of(part))
        apart = np.zeros(BITS + 1, np.int64)
        for at in range(0, len(own), 256):
            apart += np.bincount(np.bitwise_count(own[at:at + 256, None] ^ own[None]).ravel(), minlength=BITS + 1)
        apart[0] -= len(own)
        near = np.cumsum(apart) / max(1, len(own) * (len(own) - 1)) * n * n / 2
        cost = [0.0]
        for threshold in range(min(radius, 4) + 1):
            rows = sum(sum(1 for _ in flips(part, side)) for side in set(halves(threshold)))
            cost.append(ROW_COST * rows * n + near[threshold])
        options.append(cost)
    best = {0: (0.0, [])}  # by sum of (threshold + 1)
    for cost in options:
        following: dict[int, tuple[float, list[int]]] = {}
        for spent, (total, chosen) in best.items():
            for steps, extra in enumerate(cost):
                key, value = spent + steps, (total + extra, [*chosen, steps - 1])
                if key not in following or value < following[key]:
                    following[key] = value
        best = following
    total, chosen = best.get(radius + 1, (float("inf"), []))
    return chosen, total


def plan(distinct: DataFrame, radius: int) -> list[tuple[list[int], int]]:
    """The probed partitions with their thresholds, for the number of partitions that costs least."""
    n = distinct.count()
    few = distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).select("fp").collect()
    sample = np.array([r["fp"] for r in few], np.int64).view(np.uint64)
    agree = correlations(distinct)
    made = []
    for count in range(2, min(radius + 1, 8) + 1) if radius else [1]:
        parts = partitions(agree, count)
        chosen, cost = allocate(parts, radius, sample, n)
        if chosen:
            made.append((cost, [(p, t) for p, t in zip(parts, chosen) if t >= 0]))
    return min(made, key=lambda x: x[0])[1]


def _near(one: np.ndarray, other: np.ndarray, radius: int, total: int) -> np.ndarray:
    """Whether fingerprints link; lanes in the last axis."""
    apart = np.bitwise_count(one[..., 0] ^ other[..., 0])
    near = apart <= radius
    if one.shape[-1] > 1:
        whole = apart.astype(np.int16)
        for lane in range(1, one.shape[-1]):
            whole += np.bitwise_count(one[..., lane] ^ other[..., lane])
        near &= whole <= total
    return near


def _forest(values: np.ndarray, radius: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints, as row numbers."""
    waiting = np.arange(len(values))
    if len(values) <= 1024:
        linked = _near(values[:, None], values[None], radius, total).sum(axis=1) > 1
        waiting = waiting[linked]
    ends, starts = [waiting[:0]], [waiting[:0]]
    while len(waiting):
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            at = queue.pop()
            hit = _near(values[waiting], values[at], radius, total)
            if hit.any():
                found = waiting[hit]
                waiting = waiting[~hit]
                queue.extend(found.tolist())
                starts.append(np.full(len(found), at))
                ends.append(found)
    return np.concatenate(starts), np.concatenate(ends)


def _in_buckets(radius: int, total: int, lanes: list[str]):
    keys = ["part", "value", "pair"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            columns = [np.asarray(batch.column(c)) for c in [*keys, "node", *lanes]]
            if held is not None:
                columns = [np.concatenate(both) for both in zip(held, columns)]
            if not len(columns[0]):
                continue
            changed = np.zeros(len(columns[0]), bool)
            for column in columns[:3]:
                changed[1:] |= column[1:] != column[:-1]
            starts = np.append(0, np.flatnonzero(changed))
            held = [column[starts[-1]:] for column in columns]
            yield from groups(columns[3], columns[4:], starts)
        if held is not None:
            yield from groups(held[3], held[4:], np.array([0, len(held[3])]))

    def groups(nodes: np.ndarray, fps: list[np.ndarray], starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for at in np.flatnonzero(np.diff(starts) > 1):
            own, first = np.unique(nodes[starts[at]:starts[at + 1]], return_index=True)
            values = np.stack([lane[starts[at]:starts[at + 1]][first].view(np.uint64) for lane in fps], axis=-1)
            one, other = _forest(values, radius, total)
            if len(one):
                a.append(own[one])
                b.append(own[other])
        if a:
            yield pa.record_batch([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])

    return run


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def links(distinct: DataFrame, radius: int = 2, total: int = 2, lanes: int = 1) -> DataFrame:
    """Edges (a, b) between `node`s that connect whatever linked pairs of fingerprints connect."""
    named = lane_names(lanes)
    rows = None
    for number, (part, threshold) in enumerate(plan(distinct, radius)):
        masks = sorted({mask for side in halves(threshold) for mask in flips(part, side)})
        flipped = F.explode(F.array(*[F.lit(_signed(mask)) for mask in masks])).alias("flip")
        own = distinct.select("node", *named, flipped).select(
            F.lit(number).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(mask_of(part)))).bitwiseXOR(F.col("flip")).alias("value"),
            "node", *named)
        rows = own if rows is None else rows.unionByName(own)
    sizes = keep(rows.groupBy("part", "value").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    met = rows.join(sizes, ["part", "value"])
    count = F.ceil(F.col("n") / LIMIT)
    block = F.pmod(F.xxhash64("node"), count)
    # A large bucket becomes pairs of blocks, each a group of its own.
    pair = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda other: (
        F.least(block, other) * count + F.greatest(block, other)))).alias("pair")
    dealt = met.select("part", "value", pair, "node", *named).repartition("part", "value", "pair").sortWithinPartitions("part", "value", "pair")
    return dealt.mapInArrow(_in_buckets(radius, total, named), "a long, b long")


def groups(docs: DataFrame, shingle: int = 3, radius: int = 2, total: int | None = None, lanes: int = 1) -> DataFrame:
    """`docs` without `text`, with the lanes and `component_id`, the smallest doc_id that links reach (in place of such columns)."""
    named = lane_names(lanes)
    rows = keep(fingerprints(without(docs, ["component_id"]), shingle, lanes), "fingerprints")
    node = F.col("fp") if lanes == 1 else F.xxhash64(*named)
    distinct = keep(rows.groupBy(*named).agg(F.min("doc_id").alias("first")).withColumn("node", node), "distinct-fingerprints")
    joined = components(links(distinct, radius, radius if total is None else total, lanes))
    parts = keep(distinct.join(joined, "node", "left").select(*named, "first", F.coalesce("component", "node").alias("component")), "components")
    least = parts.groupBy("component").agg(F.min("first").alias("component_id"))
    return rows.join(parts.join(least, "component").select(*named, "component_id"), named).select(*map(quoted, rows.columns), "component_id")


def _described(docs: DataFrame, shingle: int, lanes: int) -> DataFrame:
    """(doc_id, _tie, node, n, sample, lanes) of the set of each document's shingles; equal sets have equal nodes."""
    made = lane_names(lanes)
    schema = T.StructType([docs.schema["doc_id"], docs.schema["_tie"], T.StructField("node", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("sample", T.ArrayType(T.LongType())), *[T.StructField(c, T.LongType()) for c in made]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "_raw"):
            nodes, sizes, samples, found = [], [], [], []
            for raw in block.column("_raw").to_pylist():
                hashes = np.unique(shingle_hashes(raw, shingle))
                nodes.append(_node(hashes))
                sizes.append(len(hashes))
                samples.append(hashes[:LEAST].view(np.int64))
                found.append(printed(hashes, lanes))
            yield pa.record_batch([block.column("doc_id"), block.column("_tie"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                                   pa.array(samples, pa.list_(pa.int64())), *map(pa.array, np.array(found, np.int64).T)],
                                  ["doc_id", "_tie", "node", "n", "sample", *made])

    return docs.select("doc_id", "_tie", F.coalesce("text", F.lit("")).cast("binary").alias("_raw")).mapInArrow(run, schema)


def _node(hashes: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh64_digest(hashes.tobytes(), SEED), "big", signed=True)


def _shared(distinct: DataFrame) -> DataFrame:
    """The nodes that may have a near copy: a fourth of their least shingles are among those of another node.

    Of two sets at 0.8, about 0.8 of the least shingles agree, so fewer than a fourth is out of reach.
    """
    least = distinct.select("node", F.size("sample").alias("of"), F.explode("sample").alias("hash"))
    several = least.groupBy("hash").agg(F.count("*").alias("nodes")).filter("nodes > 1").select("hash")
    counted = least.join(several, "hash").groupBy("node").agg(F.count("*").alias("held"), F.first("of").alias("of"))
    return counted.filter("4 * held >= of").select("node")


def similar_forest(sets: list[np.ndarray], similarity: float) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs of sets with that Jaccard similarity or more, as numbers of sets."""
    sizes = np.array([len(x) for x in sets], np.int64)
    _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    holders = owner[np.argsort(ids, kind="stable")]  # by shingle, who has it
    begins = np.cumsum(counts) - counts
    starts = np.cumsum(sizes) - sizes
    waiting = np.ones(len(sets), bool)
    a, b = [], []
    for root in range(len(sets)):
        if not waiting[root]:
            continue
        waiting[root] = False
        queue = [root]
        while queue and waiting.any():
            at = queue.pop()
            own = ids[starts[at]:starts[at] + sizes[at]]
            own = own[counts[own] > 1]
            many = counts[own]
            places = np.repeat(begins[own] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            common = np.bincount(holders[places], minlength=len(sets))
            hit = np.flatnonzero(waiting & (common > 0) & (common >= similarity * (sizes + sizes[at] - common) - 1e-9))
            waiting[hit] = False
            queue.extend(hit.tolist())
            a += [at] * len(hit)
            b += hit.tolist()
    return a, b


def _with_shingles(shingle: int):
    """The shingle set of each document, once a node, group and task: (component, pair, node, shingles)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for block in blocks(batches, "_raw"):
            rows = []
            for raw, component, pair, node in zip(*(block.column(c).to_pylist() for c in ("_raw", "component", "pair", "node"))):
                if (component, pair, node) not in seen:
                    seen.add((component, pair, node))
                    rows.append((component, pair, node, np.unique(shingle_hashes(raw, shingle)).tobytes()))
            if rows:
                yield pa.record_batch([pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                      ["component", "pair", "node", "shingles"])

    return run


def _verified(similarity: float):
    """The forest of each group of rows sorted by (component, pair)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sets = None, {}

        def done() -> Iterator[pa.RecordBatch]:
            if len(sets) > 1:
                nodes = list(sets)
                a, b = similar_forest(list(sets.values()), similarity)
                if a:
                    yield pa.record_batch([pa.array([nodes[i] for i in x], pa.int64()) for x in (a, b)], ["a", "b"])

        for batch in batches:
            for component, pair, node, raw in zip(*(batch.column(c).to_pylist() for c in ("component", "pair", "node", "shingles"))):
                if (component, pair) != group:
                    yield from done()
                    group, sets = (component, pair), {}
                if node not in sets:
                    sets[node] = np.frombuffer(raw, np.uint64)
        yield from done()

    return run


def similar_nodes(docs: DataFrame, distinct: DataFrame, shingle: int, radius: int, total: int, lanes: int, similarity: float) -> DataFrame:
    """(node, component) of the nodes that chains of pairs of that similarity or more connect.

    Candidates are the links of fingerprints, probed by each lane in turn. Their components
    are then compared by shingle sets, in blocks of bounded size for large ones, and only the
    pairs that have the similarity make the result.
    """
    named = lane_names(lanes)
    near = keep(distinct.join(_shared(distinct), "node").select("node", *named), "may-have-copies")
    candidates = None
    for lane in range(lanes):
        turned = near.select("node", *[F.col(named[(lane + i) % lanes]).alias(name) for i, name in enumerate(named)])
        found = links(turned, radius, total, lanes)
        candidates = found if candidates is None else candidates.unionByName(found)
    loose = keep(components(candidates).join(distinct.select("node", "n", "one"), "node"), "candidates")
    count = F.ceil(F.col("whole") / MOST_SHINGLES)
    block = F.pmod(F.xxhash64("node"), count)
    pair = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda other: (
        F.least(block, other) * count + F.greatest(block, other)))).alias("pair")
    dealt = (loose.join(loose.groupBy("component").agg(F.sum("n").alias("whole")), "component")
             .select("component", pair, "node", F.col("one.doc_id").alias("_id"), F.col("one._tie").alias("_one")))
    texts = docs.select("doc_id", "_tie", F.coalesce("text", F.lit("")).cast("binary").alias("_raw"))
    texts = texts.join(dealt, texts["doc_id"].eqNullSafe(dealt["_id"]) & (texts["_tie"] == dealt["_one"]))
    sets = texts.select("component", "pair", "node", "_raw").mapInArrow(_with_shingles(shingle), "component long, pair long, node long, shingles binary")
    sets = sets.repartition("component", "pair").sortWithinPartitions("component", "pair")
    return components(sets.mapInArrow(_verified(similarity), "a long, b long"))


def first_of_groups(docs: DataFrame, shingle: int = 5, radius: int = 12, total: int = 60, lanes: int = 4, similarity: float = 0.8) -> DataFrame:
    """One document of each group, the one with the smallest doc_id; of repeated rows one stays.

    Groups are chains of documents whose sets of shingles have a Jaccard similarity of
    `similarity` or more. Fingerprints of the sets only find the candidates: at 0.8 they
    differ in 39 of 256 bits on average (standard deviation 6), and in 10 of a lane's 64 (3),
    so a pair is missed if all of four lanes differ in more than 12 or the whole in more than
    60. A null doc_id stays only in a group without other ids.
    """
    docs, columns = set_aside(docs, "doc_id", "text")
    tied = docs.withColumn("_tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    described = keep(_described(tied, shingle, lanes), "shingle-sets")
    rank = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_tie")
    named = lane_names(lanes)
    alike = [F.any_value(c).alias(c) for c in ("n", "sample", *named)]  # equal for equal sets
    distinct = keep(described.groupBy("node").agg(F.min(rank).alias("one"), *alike), "distinct-shingle-sets")
    joined = similar_nodes(tied, distinct, shingle, radius, total, lanes, similarity)
    # The least of a node is known, so only one row of each node goes on.
    least = (distinct.join(joined, "node", "left").groupBy(F.coalesce("component", "node").alias("component"))
             .agg(F.min("one").alias("one")))
    kept = least.select(F.col("one.doc_id").alias("_id"), F.col("one._tie").alias("_least"))
    whole = tied.join(kept, tied["doc_id"].eqNullSafe(kept["_id"]) & (tied["_tie"] == kept["_least"]), "left_semi")
    return whole.dropDuplicates(["doc_id", "_tie"]).select(*columns)

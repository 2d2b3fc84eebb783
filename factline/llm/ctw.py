"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A text is its words, in lower case, each followed by a space or, after the last, by the end
symbol. A byte is eight binary choices; each choice has a context tree over the bytes before
it, down to `DEPTH` of them. A node's Krichevsky-Trofimov estimate of its counts is mixed half
and half with the product of its children's mixtures, so every node carries the weight with
which the tree stops there; the prediction for a byte mixes the estimates of all depths on its
path by these weights. Words are also scored by a smoothed unigram model as a base.

Counts are exact and over all training documents; the model has no size limit, and its parts
meet without being gathered anywhere. Texts are packed into blocks, one for each task. A
block sends each distinct byte string (context and next byte) and word once, with its count;
these are summed across blocks, the trees are built from groups that share three bytes of
context (at most 256**3 strings each) and, above these, by aggregation; and each block gets
back the values of just what it holds, by which its texts are scored.

Defined cases: a null or empty text is the end symbol alone; a null doc_id is in training;
repeated rows and shared ids are scored (and counted) row by row; without any training text
all choices are even; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.llm.arrow import blocks, padded
from factline.llm.phrases import word_hashes
from factline.llm.recurring import words_of_eight
from factline.storage import keep

DEPTH = 5
END = 10
#: Text in a block and in a chunk of it, and strings whose trees are built at once.
BLOCK_CHARS, CHUNK_BYTES, AT_ONCE = 64 << 20, 1 << 18, 30_000
STRING, WORD, TEXTS = 0, 1, 2
_WHOLE = np.uint64((1 << 8 * (DEPTH + 1)) - 1)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function of positive numbers."""
    shift = np.ones_like(x)
    for i in range(8):
        shift *= np.where(x < 1e6, x + i, 1.0)
    z = np.where(x < 1e6, x + 8, x)
    series = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return series - np.log(shift)


#: log_gamma of small counts and a half, and of small counts and one: nearly all counts are small.
_SMALL = 1 << 12
_TABLES = {plus: log_gamma(np.arange(_SMALL) + plus) for plus in (0.5, 1.0)}


def _log_gamma_of(counts: np.ndarray, plus: float) -> np.ndarray:
    """log_gamma(counts + plus) of whole numbers."""
    small = counts < _SMALL
    found = _TABLES[plus][np.where(small, counts, 0).astype(np.intp)]
    if not small.all():
        found[~small] = log_gamma(counts[~small] + plus)
    return found


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of any sequence with these counts."""
    return _log_gamma_of(zeros, 0.5) + _log_gamma_of(ones, 0.5) - np.log(np.pi) - _log_gamma_of(zeros + ones, 1.0)


def strings_of(texts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The string of every byte, its context before it; a text starts as if after end symbols."""
    data, starts = padded(texts, offsets, DEPTH)
    sizes = np.diff(offsets)
    own = np.zeros(len(data), bool)
    own[np.arange(len(texts)) + np.repeat(DEPTH * np.arange(1, len(sizes) + 1), sizes)] = True
    data[~own] = END
    return words_of_eight(data)[np.flatnonzero(own) - DEPTH] & _WHOLE


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(inverse, np.concatenate(counts), len(found)).astype(np.int64)


class _Counts:
    """Counts by key, merged now and then."""

    def __init__(self):
        self._keys, self._counts, self._waiting = [], [], 0

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        for part, weight in ((keys[train], 1), (keys[~train], 0)):
            found, counts = np.unique(part, return_counts=True)
            self._keys.append(found)
            self._counts.append(counts * weight)
            self._waiting += len(found)
        if self._waiting > 1_500_000:
            self._keys, self._counts = map(lambda x: [x], self.total())
            self._waiting = 0

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        return _summed(self._keys, self._counts)

    def clear(self) -> None:
        self.__init__()


_PACKED = "block int, kind int, key long, n long, payload binary, ids binary, marks binary"


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's texts in compressed chunks, and the counts of all strings and words in them."""
    block = TaskContext.get().partitionId()
    strings, words, chunk = _Counts(), _Counts(), 0
    compress = zstandard.ZstdCompressor(level=3).compress

    def rows(kind, key, n, payload=None, ids=None, marks=None) -> pa.RecordBatch:
        size = len(key)
        full = lambda x: pa.array([x] * size, pa.binary()) if x is None else pa.array([x], pa.binary())
        return pa.record_batch([pa.array(np.full(size, block, np.int32)), pa.array(np.full(size, kind, np.int32)), pa.array(key.view(np.int64)),
                                pa.array(n), full(payload), full(ids), full(marks)], ["block", "kind", "key", "n", "payload", "ids", "marks"])

    for part in blocks(batches, "text", CHUNK_BYTES):
        texts = [b" ".join(x.lower().split()) + b"\n" for x in part.column("text").to_pylist()]
        held = np.asarray(part.column("held_out").to_pylist(), bool)
        sizes = np.array([len(x) for x in texts], np.int64)
        joined = b"".join(texts)
        strings.add(strings_of(np.frombuffer(joined, np.uint8), np.append(0, np.cumsum(sizes))), np.repeat(~held, sizes))
        hashes, counts = word_hashes(pa.array(texts, pa.binary()))
        words.add(hashes, np.repeat(~held, counts))
        words.add(np.zeros(len(texts), np.uint64), ~held)
        ids = part.column("doc_id").to_pylist()
        marks = np.array([[s, h, i is None] for s, h, i in zip(sizes, held, ids)], np.int64)
        yield rows(TEXTS, np.array([chunk]), np.array([0]), compress(joined),
                   np.array([0 if i is None else i for i in ids], np.int64).tobytes(), marks.tobytes())
        chunk += 1
    if chunk:
        for kind, counted in ((STRING, strings), (WORD, words)):
            key, n = counted.total()
            counted.clear()
            for at in range(0, len(key), 50_000):
                yield rows(kind, key[at:at + 50_000], n[at:at + 50_000])


class Trees:
    """Mixtures of the trees whose strings share at least three bytes of context, by depth from DEPTH up to 3."""

    def __init__(self, strings: np.ndarray, counts: np.ndarray):
        strings = strings.astype(np.int64)
        last = strings >> 8 * DEPTH
        steps = np.arange(8)
        node = (1 << steps) | (last[:, None] >> (8 - steps))
        self.bit = (last[:, None] >> (7 - steps)) & 1
        keys = ((strings & ((1 << 8 * DEPTH) - 1))[:, None] << 8 | node).ravel()
        ones = (counts[:, None] * self.bit).ravel().astype(float)
        zeros = (counts[:, None] * (1 - self.bit)).ravel().astype(float)
        below = None
        self.levels = []
        for depth in range(DEPTH, 2, -1):
            found, inverse = np.unique(keys, return_inverse=True)
            zeros, ones = np.bincount(inverse, zeros, len(found)), np.bincount(inverse, ones, len(found))
            own = log_estimate(zeros, ones)
            if below is None:
                stop, mixture = np.ones(len(found)), own
            else:
                below = np.bincount(inverse, below, len(found))
                stop, mixture = weigh(own, below)
            self.levels.append((found, inverse, stop, (ones + 0.5) / (zeros + ones + 1.0)))
            below = mixture
            keys = (found >> 16) << 8 | (found & 255)
        self.keys, self.zeros, self.ones, self.mixture = found, zeros, ones, mixture

    def log10(self, keys: np.ndarray, known: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Of every string, the probability of its last byte; known, left: what shallower depths predict, and the weight that they leave."""
        at = np.searchsorted(keys, self.keys)
        known, left = known[at], left[at]
        for depth, (_, inverse, stop, estimate) in enumerate(reversed(self.levels)):
            known, left = known + left * stop * estimate, left * (1 - stop)
            known, left = known[self.levels[-1 - depth][1]], left[self.levels[-1 - depth][1]]
        chosen = np.where(self.bit.ravel() == 1, known, 1 - known)
        return np.log10(chosen).reshape(-1, 8).sum(axis=1)


def weigh(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weight of stopping at nodes, and their mixtures: half the estimate, half the product below."""
    return 1 / (1 + np.exp(np.minimum(below - own, 700.0))), np.logaddexp(own, below) - np.log(2)


def _by_context(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first one, cut between its values into parts of AT_ONCE rows or more."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if batch.num_rows:
            held.append([np.asarray(batch.column(c)) for c in columns])
        if sum(len(x[0]) for x in held) >= AT_ONCE:
            whole = [np.concatenate(x) for x in zip(*held)]
            cut = int(np.searchsorted(whole[0], whole[0][-1]))
            if cut:
                yield [x[:cut] for x in whole]
            held = [[x[cut:] for x in whole]]
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _lowest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes at three bytes of context: (node, zeros, ones, mixture)."""
    for _, key, n in _by_context(batches, ["context", "key", "n"]):
        trees = Trees(key, n)
        yield pa.record_batch([pa.array(trees.keys), pa.array(trees.zeros), pa.array(trees.ones), pa.array(trees.mixture)],
                              ["node", "zeros", "ones", "mixture"])


def _valued(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The value of every string: (key, value)."""
    for _, kind, key, n, known, left in _by_context(batches, ["context", "kind", "key", "n", "known", "left"]):
        node = kind == 0
        order = np.argsort(key[node])
        strings = key[~node]
        values = Trees(strings, n[~node]).log10(key[node][order], known[node][order], left[node][order])
        yield pa.record_batch([pa.array(strings), pa.array(values)], ["key", "value"])


def _weighed(zeros: pd.Series, ones: pd.Series, below: pd.Series) -> pd.DataFrame:
    stop, mixture = weigh(log_estimate(zeros.to_numpy(float), ones.to_numpy(float)), below.to_numpy(float))
    return pd.DataFrame({"stop": stop, "mixture": mixture})


def _shorter(node: str) -> Column:
    """The same choice with one byte of context less."""
    return F.shiftleft(F.shiftright(node, 16), 8).bitwiseOR(F.col(node).bitwiseAND(F.lit(255)))


def string_values(strings: DataFrame) -> DataFrame:
    """(key, value): log10 of the probability of the last byte of each string (key, n) after its context."""
    context = F.shiftright("key", 8 * (DEPTH - 3)).bitwiseAND(F.lit((1 << 24) - 1))
    strings = strings.select(context.alias("context"), "key", "n")
    nodes = keep(strings.repartition("context").sortWithinPartitions("context")
                 .mapInArrow(_lowest, "node long, zeros double, ones double, mixture double"), "nodes-3")
    weighed_by = F.pandas_udf(_weighed, "struct<stop:double,mixture:double>")
    levels = [nodes]
    for depth in (2, 1, 0):
        summed = levels[-1].groupBy(_shorter("node").alias("node")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("mixture").alias("below"))
        weighed = summed.withColumn("w", weighed_by("zeros", "ones", "below"))
        levels.append(keep(weighed.select("node", "zeros", "ones", "w.stop", "w.mixture"), f"nodes-{depth}"))
    estimate = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    above = levels[3].select("node", (F.col("stop") * estimate).alias("known"), (1 - F.col("stop")).alias("left"))
    for level in (levels[2], levels[1]):
        joined = level.withColumn("parent", _shorter("node")).join(above.withColumnRenamed("node", "parent"), "parent")
        above = joined.select("node", (F.col("known") + F.col("left") * F.col("stop") * estimate).alias("known"),
                              (F.col("left") * (1 - F.col("stop"))).alias("left"))
    given = (nodes.select("node", _shorter("node").alias("parent")).join(above.withColumnRenamed("node", "parent"), "parent")
             .select(F.shiftright("node", 8).alias("context"), F.lit(0).alias("kind"), F.col("node").alias("key"), F.lit(0).cast("long").alias("n"), "known", "left"))
    asked = strings.select("context", F.lit(1).alias("kind"), "key", "n", F.lit(0.0).alias("known"), F.lit(0.0).alias("left"))
    return (given.unionByName(asked).repartition("context").sortWithinPartitions("context")
            .mapInArrow(_valued, "key long, value double"))


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Score the chunks of a block by the values before them; rows come by block, kind and key."""
    block, tables, held = None, {}, {}
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        number, kind = np.asarray(batch.column("block")), np.asarray(batch.column("kind"))
        cuts = np.flatnonzero(np.diff(number) | np.diff(kind)) + 1
        for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
            if stop == start:
                continue
            if number[start] != block:
                block, tables, held = number[start], {}, {STRING: [], WORD: []}
            part = batch.slice(start, stop - start)
            if kind[start] != TEXTS:
                held[kind[start]].append([np.array(part.column(c)) for c in ("key", "value")])
                continue
            if not tables:
                for k, parts in held.items():
                    key, value = (np.concatenate(x) for x in zip(*parts))
                    order = np.argsort(key.view(np.uint64))
                    tables[k] = key.view(np.uint64)[order], value[order]
                    parts.clear()
                held = {}
                pa.default_memory_pool().release_unused()
            for at in range(part.num_rows):
                payload, ids, marks = (part.column(c)[at].as_py() for c in ("payload", "ids", "marks"))
                yield _scored(expand(payload), np.frombuffer(ids, np.int64), np.frombuffer(marks, np.int64).reshape(-1, 3), tables)


def _scored(joined: bytes, ids: np.ndarray, marks: np.ndarray, tables: dict) -> pa.RecordBatch:
    sizes, held, absent = marks.T
    offsets = np.append(0, np.cumsum(sizes))
    text = np.frombuffer(joined, np.uint8)
    score = np.add.reduceat(_looked_up(tables[STRING], strings_of(text, offsets)), offsets[:-1])
    arrays = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
    hashes, counts = word_hashes(arrays)
    # A word's value is below zero; one that training does not know carries 1,000 less.
    value = _looked_up(tables[WORD], np.append(hashes, np.uint64(0)))
    known = value > -900
    value = np.where(known, value, value + 1000)
    of = np.repeat(np.arange(len(sizes)), counts)
    base = np.bincount(of, value[:-1], len(sizes)) + value[-1]
    n_known = np.bincount(of, known[:-1], len(sizes)).astype(np.int64) + int(known[-1])
    return pa.record_batch([
        pa.array(ids, mask=absent.astype(bool)), pa.array(held.astype(bool)), pa.array(counts.astype(np.int64) + 1),
        pa.array(n_known), pa.array(base), pa.array(score)], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def _looked_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    return table[1][np.searchsorted(table[0], keys)]


def scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document.

    `held_out` marks documents that the models do not learn from. Scores are log10
    probabilities of whole texts; `score` over the bytes of a text is its code length.
    """
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    packed = keep(texts.coalesce(total // BLOCK_CHARS + 1).mapInArrow(_pack, _PACKED), "packed-texts")
    parts = packed.filter(F.col("kind") != TEXTS).select("block", "kind", "key", "n")
    sums = keep(parts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    words = sums.filter(F.col("kind") == WORD)
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    share = F.log10((F.col("n") + 0.1) / F.lit(n + 0.1 * (v + 1)))
    values = words.select("kind", "key", F.when(F.col("n") > 0, share).otherwise(share - 1000).alias("value")).unionByName(
        string_values(sums.filter(F.col("kind") == STRING).select("key", "n")).select(F.lit(STRING).alias("kind"), "key", "value"))
    nothing = F.lit(None).cast("binary")
    back = parts.select("block", "kind", "key").join(values, ["kind", "key"]).select(
        "block", "kind", "key", "value", nothing.alias("payload"), nothing.alias("ids"), nothing.alias("marks"))
    chunks = packed.filter(F.col("kind") == TEXTS).select("block", "kind", "key", F.lit(0.0).alias("value"), "payload", "ids", "marks")
    dealt = back.unionByName(chunks).repartition("block").sortWithinPartitions("block", "kind")
    scored = dealt.mapInArrow(_score, _SCORES)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")

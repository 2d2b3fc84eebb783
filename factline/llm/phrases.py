"""Removal of repeated phrases with sharded Aho-Corasick automata.

Every word covered by a window of `length` words whose sequence also starts in a document
with a smaller doc_id goes. Contexts around anchors that recur (see recurring.py) are dealt by
anchor into shards. A shard confirms which windows recur in several documents, compiles them
into one automaton over its words, and streams its contexts through it to locate every
occurrence; those outside the smallest document are repeats. No other part of any document
can hold a repeat, so all documents are covered though most of their text is never moved.
Anchors with more contexts than fit a shard are compared by hashes of their windows, which
Spark groups with map-side combination.

Defined cases: a null text has no words and a text of fewer than `length` words loses nothing;
a null doc_id comes before all others. A doc_id and a text make a document: texts that share
an id, or have none, are documents of their own, ordered by a hash of the text; repeated rows
are one document and each gets what the document loses. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.llm.arrow import blocks, flat, padded
from factline.llm.recurring import OPEN, REPEAT, applied, cover, minimizers, mixed, numbered, ordered, recurring

GRAM = 16
SHARD_WORDS = 100_000
_STEP = 0x9E3779B97F4A7C15
_MANY = np.array([pow(_STEP, i, 1 << 64) for i in range(1, 257)], np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of the texts, and how many words each text has."""
    text, offsets = flat(texts)
    data, starts = padded(text, offsets, 1)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    space[starts - 1] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    begin, end = edges[::2], edges[1::2]
    n = len(data)
    forward = np.full(n + 1, _STEP, np.uint64)
    backward = np.full(n + 1, pow(_STEP, -1, 1 << 64), np.uint64)
    forward[0] = backward[0] = 1
    forward, backward = np.cumprod(forward, dtype=np.uint64), np.cumprod(backward, dtype=np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forward[:n], out=sums[1:])
    hashes = mixed((sums[end] - sums[begin]) * backward[begin] + (end - begin).astype(np.uint64))
    counts = np.bincount(np.searchsorted(starts, begin, side="right") - 1, minlength=len(starts))
    return hashes, counts[:len(starts)]


def word_contexts(length: int):
    """Contexts of the anchors of texts for windows of `length` words."""
    window = length - GRAM + 1

    def contexts(texts: pa.Array) -> tuple[np.ndarray, ...]:
        hashes, counts = word_hashes(texts)
        first = np.cumsum(counts) - counts
        n = max(0, len(hashes) - GRAM + 1)
        grams = np.zeros(n, np.uint64)
        for i in range(GRAM):
            grams += hashes[i:i + n] * _MANY[i]
        grams = mixed(grams)
        some = np.flatnonzero(counts >= length)
        at = minimizers(grams, first[some], counts[some] - GRAM + 1, window)
        number = some[np.searchsorted(first[some], at, side="right") - 1] if len(at) else at
        start = np.maximum(first[number], at - window + 1)
        end = np.minimum(first[number] + counts[number], at + length)
        context = ((at - start) << 32 | (end - start)).astype(np.uint64)
        for offset in range(length + window - 1):
            place = start + offset
            word = np.where(place < end, hashes[np.minimum(place, len(hashes) - 1)], np.uint64(0)) if len(at) else context
            context = context * np.uint64(_STEP) + word
        return number, grams[at], mixed(context), start - first[number], end - start

    return contexts


def _cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each document's open contexts, joined by spaces: (anchor, doc, tie, start, words)."""
    for block in blocks(batches, "text"):
        anchors, docs, ties, starts, parts = [], [], [], [], []
        for doc, tie, raw, wanted in zip(*(block.column(c).to_pylist() for c in ("doc", "tie", "text", "wanted"))):
            words = raw.split()  # bytes: exactly the word rule's white space
            for x in wanted:
                anchors.append(x["anchor"])
                docs.append(doc)
                ties.append(tie)
                starts.append(x["start"])
                parts.append(b" ".join(words[x["start"]:x["start"] + x["size"]]))
        yield pa.record_batch([pa.array(anchors, pa.int64()), pa.array(docs, pa.int64()), pa.array(ties, pa.int64()), pa.array(starts, pa.int32()),
                               pa.array(parts, pa.binary())], ["anchor", "doc", "tie", "start", "words"])


def repeats_in(docs: list[int], starts: list[int], contexts: list[bytes], length: int) -> tuple[list[int], list[int]]:
    """Document and place of every window of the contexts that a smaller document also has."""
    letters: dict[bytes, str] = {}  # a letter for each word, past the surrogates

    def letter(word: bytes) -> str:
        return letters.setdefault(word, chr(len(letters) + (1 if len(letters) < 0xD7FF else 0x801)))

    coded = ["".join(map(letter, context.split(b" "))) for context in contexts]
    least: dict[str, int] = {}
    recurs: set[str] = set()
    for doc, context in zip(docs, coded):
        for i in range(len(context) - length + 1):
            window = context[i:i + length]
            known = least.setdefault(window, doc)
            if known != doc:
                recurs.add(window)
                if doc < known:
                    least[window] = doc
    if not recurs:
        return [], []
    automaton = ahocorasick.Automaton()
    for window in recurs:
        automaton.add_word(window, least[window])
    del least, recurs
    automaton.make_automaton()
    found_docs, found_places = [], []
    for doc, start, context in zip(docs, starts, coded):
        for end, smallest in automaton.iter(context):
            if doc != smallest:
                found_docs.append(doc)
                found_places.append(start + end - length + 1)
    return found_docs, found_places


def _in_shards(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, docs, ties, starts, contexts = None, [], [], [], []

        def done() -> Iterator[pa.RecordBatch]:
            if len(contexts) > 1:
                number, own_docs, own_ties = numbered(np.array(docs, np.int64), np.array(ties, np.int64))
                found, places = repeats_in(number.tolist(), starts, contexts, length)
                if found:
                    spans = sorted(set(zip(found, places)))
                    yield pa.record_batch([pa.array([own_docs[d] for d, _ in spans], pa.int64()), pa.array([own_ties[d] for d, _ in spans], pa.int64()), pa.array([p for _, p in spans], pa.int32()),
                                           pa.array([p + length for _, p in spans], pa.int32())], ["doc", "tie", "start", "end"])

        for batch in batches:
            for number, doc, tie, start, context in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc", "tie", "start", "words"))):
                if number != shard:
                    yield from done()
                    shard, docs, ties, starts, contexts = number, [], [], [], []
                docs.append(doc)
                ties.append(tie)
                starts.append(start)
                contexts.append(context)
        yield from done()

    return run


def _windows(length: int):
    """Each window of a context, as two hashes: (one, other, doc, tie, start)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tie, start, one, other = [], [], [], [], []
            for d, t, s, context in zip(*(batch.column(c).to_pylist() for c in ("doc", "tie", "start", "words"))):
                words = context.split(b" ")
                for i in range(len(words) - length + 1):
                    digest = hashlib.blake2b(b" ".join(words[i:i + length]), digest_size=16).digest()
                    one.append(int.from_bytes(digest[:8], "little", signed=True))
                    other.append(int.from_bytes(digest[8:], "little", signed=True))
                    doc.append(d)
                    tie.append(t)
                    start.append(s + i)
            yield pa.record_batch([pa.array(one, pa.int64()), pa.array(other, pa.int64()), pa.array(doc, pa.int64()),
                                   pa.array(tie, pa.int64()), pa.array(start, pa.int32())], ["one", "other", "doc", "tie", "start"])

    return run


def repeated_spans(docs: DataFrame, length: int = 50, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Spans of words (doc, tie, start, end) whose union is what each ordered document loses."""
    found = recurring(docs, word_contexts(length), alone=False)
    known = found.filter(F.col("kind") == REPEAT).select("doc", "tie", "start", (F.col("start") + F.col("size")).alias("end"))
    opened = found.filter(F.col("kind") == OPEN)
    total = opened.agg(F.sum("size")).first()[0] or 0
    shards = total // shard_words + 1
    crowd = opened.groupBy("anchor").agg(F.sum("size").alias("words")).filter(F.col("words") > 4 * shard_words).select("anchor", F.lit(True).alias("crowded"))
    wanted = (opened.join(crowd, "anchor", "left").groupBy("doc", "tie")
              .agg(F.collect_list(F.struct("anchor", "start", "size", "crowded")).alias("wanted")))
    # One shuffle of the texts serves this join and the last one.
    texts = docs.join(wanted, ["doc", "tie"]).select("doc", "tie", "text", "wanted")

    def cut_out(chosen: Callable[[Column], Column]) -> DataFrame:
        some = texts.withColumn("wanted", F.filter("wanted", lambda x: chosen(x["crowded"])))
        return some.filter(F.size("wanted") > 0).mapInArrow(_cut_out, "anchor long, doc long, tie long, start int, words binary")

    dealt = cut_out(F.isnull).withColumn("shard", F.pmod("anchor", F.lit(shards))).repartition("shard").sortWithinPartitions("shard")
    spans = dealt.mapInArrow(_in_shards(length), "doc long, tie long, start int, end int")
    windows = cut_out(F.isnotnull).mapInArrow(_windows(length), "one long, other long, doc long, tie long, start int")
    least = windows.groupBy("one", "other").agg(F.min(F.struct("doc", "tie")).alias("least"), F.max(F.struct("doc", "tie")).alias("most")).filter("least < most")
    later = (windows.join(least, ["one", "other"]).filter(F.struct("doc", "tie") > F.col("least"))
             .select("doc", "tie", "start", (F.col("start") + length).alias("end")))
    return known.unionByName(spans).unionByName(later)


def kept_words(docs: DataFrame, length: int = 50, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, text): the kept words of each document, joined by one space."""

    def result(raw: bytes, spans: list | None) -> tuple[int, int, str]:
        words = raw.split()
        runs = cover(spans, len(words))
        kept, at = [], 0
        for start, end in runs:
            kept += words[at:start]
            at = end
        kept += words[at:]
        return len(words), len(words) - len(kept), b" ".join(kept).decode()

    source = ordered(docs)
    return applied(source, repeated_spans(source, length, shard_words), result,
                   "doc_id long, n_words long, n_removed long, text string", (pa.int64(), pa.int64(), pa.string()))

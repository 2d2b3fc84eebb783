"""Removal of repeated byte strings with suffix arrays built by induced sorting.

Every byte of a `length`-byte string that also starts earlier (in a smaller doc_id, or before
in the same document) goes. Contexts around anchors that recur (see recurring.py) are dealt
by anchor into shards of a few megabytes; a shard's contexts are joined, sorted by induced
sorting, and common prefixes of `length` bytes, taken in text order, show which strings are
equal. The earliest of each stays. As equal strings have equal anchors, a shard sees all it
needs. Anchors with more contexts than fit a shard are compared by hashes of their strings,
which Spark groups with map-side combination.

Defined cases: a null text is empty and a text shorter than `length` loses nothing; a null
doc_id comes before all others. A doc_id and a text make a document: texts that share an id,
or have none, are documents of their own, ordered by a hash of the text; repeated rows are one
document, neither is earlier than the other, and each gets what the document loses. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.llm.arrow import blocks, flat, padded
from factline.llm.recurring import OPEN, REPEAT, applied, cover, mixed, numbered, ordered, owned, recurring, words_of_eight
from factline.llm.suffixes import common_prefixes, suffix_array

GRAM = 32
SHARD_BYTES = 4 << 20
_WEIGHTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def byte_contexts(length: int):
    """Contexts of the anchors of texts for strings of `length` bytes.

    A string has one anchor, the least of its grams; an anchor's context is its own strings, so
    each string is judged once.
    """
    window = length - GRAM + 1

    def contexts(texts: pa.Array) -> tuple[np.ndarray, ...]:
        text, offsets = flat(texts)
        data, starts = padded(text, offsets, length)
        data = np.concatenate([data, np.zeros(length + GRAM, np.uint8)])
        sizes = np.diff(offsets)
        eights = words_of_eight(data)
        n = max(0, len(data) - GRAM)
        hashes = np.zeros(n, np.uint64)
        for i, weight in enumerate(_WEIGHTS):
            hashes += mixed(eights[8 * i:8 * i + n] * weight)
        at, start, last = owned(hashes, starts, np.maximum(sizes - GRAM + 1, 0), window)
        number = np.searchsorted(starts, at, side="right") - 1
        end = last + length
        context = mixed(((at - start) << 32 | (end - start)).astype(np.uint64))
        for offset in range(0, length + window, 8):
            context = mixed(context * _WEIGHTS[1] + eights[np.minimum(start + offset, len(eights) - 1)])
        return number, hashes[at], context, start - starts[number], end - start

    return contexts


def _cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each document's open contexts: (anchor, doc, tie, start, bytes)."""
    for block in blocks(batches, "text"):
        anchors, docs, ties, starts, parts = [], [], [], [], []
        for doc, tie, raw, wanted in zip(*(block.column(c).to_pylist() for c in ("doc", "tie", "text", "wanted"))):
            for x in wanted:
                anchors.append(x["anchor"])
                docs.append(doc)
                ties.append(tie)
                starts.append(x["start"])
                parts.append(raw[x["start"]:x["start"] + x["size"]])
        yield pa.record_batch([pa.array(anchors, pa.int64()), pa.array(docs, pa.int64()), pa.array(ties, pa.int64()), pa.array(starts, pa.int32()),
                               pa.array(parts, pa.binary())], ["anchor", "doc", "tie", "start", "bytes"])


def repeats_in(docs: np.ndarray, starts: np.ndarray, contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and place of every `length`-byte string of the contexts that an earlier one equals."""
    sizes = np.array([len(x) for x in contexts], np.int64)
    raw = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    begins = np.cumsum(sizes + 1) - sizes - 1
    symbols = raw.astype(np.int32) + 2
    symbols[begins + sizes] = 1
    array = suffix_array(np.append(symbols, 0))
    whole = np.maximum(sizes - length + 1, 0)
    of = np.repeat(np.arange(len(sizes), dtype=np.int32), whole)  # every place where a string starts, in text order
    places = np.arange(len(of), dtype=np.int32) + np.repeat((begins - np.cumsum(whole) + whole).astype(np.int32), whole)
    del of
    shared = common_prefixes(words_of_eight(raw), array[1:], places, length)
    joined = np.zeros(len(array), bool)
    joined[places] = shared >= length
    ranked = joined[array]  # equal to the string before it in the array
    group = np.cumsum(~ranked, dtype=np.int32)
    member = np.zeros(len(array), bool)
    member[np.flatnonzero(ranked)] = True
    member[np.flatnonzero(ranked) - 1] = True
    at = array[member]
    group = group[member]
    number = np.searchsorted(begins, at, side="right") - 1
    doc, place = docs[number], starts[number] + at - begins[number]
    order = np.lexsort((place, doc, group))
    doc, place, group = doc[order], place[order], group[order]
    head = np.ones(len(group), bool)
    head[1:] = group[1:] != group[:-1]
    owner = np.flatnonzero(head)[np.cumsum(head) - 1]
    later = (doc != doc[owner]) | (place != place[owner])
    return doc[later], place[later]


def _runs(doc: np.ndarray, place: np.ndarray, length: int, docs: np.ndarray, ties: np.ndarray) -> pa.RecordBatch:
    """Repeated strings as spans of numbered documents; neighbours make one."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    opens = np.ones(len(doc), bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + length)
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(doc)) - 1
    return pa.record_batch([pa.array(docs[doc[first]]), pa.array(ties[doc[first]]), pa.array(place[first].astype(np.int32)),
                            pa.array((place[last] + length).astype(np.int32))], ["doc", "tie", "start", "end"])


def _in_shards(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, docs, ties, starts, contexts = None, [], [], [], []

        def done() -> Iterator[pa.RecordBatch]:
            if len(contexts) > 1:
                number, own_docs, own_ties = numbered(np.array(docs, np.int64), np.array(ties, np.int64))
                doc, place = repeats_in(number, np.array(starts, np.int64), contexts, length)
                if len(doc):
                    yield _runs(doc, place, length, own_docs, own_ties)

        for batch in batches:
            for number, doc, tie, start, context in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc", "tie", "start", "bytes"))):
                if number != shard:
                    yield from done()
                    shard, docs, ties, starts, contexts = number, [], [], [], []
                docs.append(doc)
                ties.append(tie)
                starts.append(start)
                contexts.append(context)
        yield from done()

    return run


def _strings(length: int):
    """Each string of a context, as two hashes: (one, other, doc, tie, start)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tie, start, one, other = [], [], [], [], []
            for d, t, s, context in zip(*(batch.column(c).to_pylist() for c in ("doc", "tie", "start", "bytes"))):
                for i in range(len(context) - length + 1):
                    digest = hashlib.blake2b(context[i:i + length], digest_size=16).digest()
                    one.append(int.from_bytes(digest[:8], "little", signed=True))
                    other.append(int.from_bytes(digest[8:], "little", signed=True))
                    doc.append(d)
                    tie.append(t)
                    start.append(s + i)
            yield pa.record_batch([pa.array(one, pa.int64()), pa.array(other, pa.int64()), pa.array(doc, pa.int64()),
                                   pa.array(tie, pa.int64()), pa.array(start, pa.int32())], ["one", "other", "doc", "tie", "start"])

    return run


def repeated_spans(docs: DataFrame, length: int = 100, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Spans (doc, tie, start, end) whose union is what each ordered document loses."""
    found = recurring(docs, byte_contexts(length), alone=True)
    known = found.filter(F.col("kind") == REPEAT).select("doc", "tie", "start", (F.col("start") + F.col("size")).alias("end"))
    opened = found.filter((F.col("kind") == OPEN) & (F.col("size") >= length))
    total = opened.agg(F.sum("size")).first()[0] or 0
    # A shard is a fourth of what one anchor may bring, so that most suffix arrays are small.
    shards = total // max(1, shard_bytes // 4) + 1
    crowd = opened.groupBy("anchor").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > shard_bytes).select("anchor", F.lit(True).alias("crowded"))
    wanted = (opened.join(crowd, "anchor", "left").groupBy("doc", "tie")
              .agg(F.collect_list(F.struct("anchor", "start", "size", "crowded")).alias("wanted")))
    # One shuffle of the texts serves this join and the last one.
    texts = docs.join(wanted, ["doc", "tie"]).select("doc", "tie", "text", "wanted")

    def cut_out(chosen: Callable[[Column], Column]) -> DataFrame:
        some = texts.withColumn("wanted", F.filter("wanted", lambda x: chosen(x["crowded"])))
        return some.filter(F.size("wanted") > 0).mapInArrow(_cut_out, "anchor long, doc long, tie long, start int, bytes binary")

    calm, crowded = cut_out(F.isnull), cut_out(F.isnotnull)
    dealt = calm.withColumn("shard", F.pmod("anchor", F.lit(shards))).repartition("shard").sortWithinPartitions("shard")
    spans = dealt.mapInArrow(_in_shards(length), "doc long, tie long, start int, end int")
    strings = crowded.mapInArrow(_strings(length), "one long, other long, doc long, tie long, start int")
    first = strings.groupBy("one", "other").agg(F.min(F.struct("doc", "tie", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = (strings.join(first, ["one", "other"]).filter(F.struct("doc", "tie", "start") != F.col("first"))
             .select("doc", "tie", "start", (F.col("start") + length).alias("end")))
    return known.unionByName(spans).unionByName(later)


def _without(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in runs:
        kept.append(raw[at:start])
        at = end
    return b"".join([*kept, raw[at:]])


def kept_bytes(docs: DataFrame, length: int = 100, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, kept, spans): the remaining bytes of each document and its maximal removed runs (start, end)."""

    def result(raw: bytes, spans: list | None) -> tuple[bytes, list]:
        runs = cover(spans, len(raw))
        return _without(raw, runs), [{"start": start, "end": end} for start, end in runs]

    source = ordered(docs)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    return applied(source, repeated_spans(source, length, shard_bytes), result,
                   "doc_id long, kept binary, spans array<struct<start:int,end:int>>", (pa.binary(), pa.list_(span)))


def digests(docs: DataFrame, length: int = 100, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each document."""

    def result(raw: bytes, spans: list | None) -> tuple[int, int, int, str]:
        runs = cover(spans, len(raw))
        return len(raw), sum(end - start for start, end in runs), len(runs), hashlib.sha256(_without(raw, runs)).hexdigest()

    source = ordered(docs)
    return applied(source, repeated_spans(source, length, shard_bytes), result,
                   "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
                   (pa.int64(), pa.int64(), pa.int64(), pa.string()))

"""Places that recur across documents, found by anchors and folded before anything is compared.

A sequence of symbols (bytes or words) is sampled at its minimizers: of every `span`
consecutive symbols at least one `gram` is an anchor, picked by content alone, so equal
stretches have equal anchors at equal places. An anchor's context is everything that a
stretch around it can cover. Equal contexts are folded: the earliest stays, the others are
known to be repeats as a whole. What is left to compare are contexts that share an anchor
but are not equal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factline.llm.arrow import blocks
from factline.storage import keep

ROWS = "kind int, anchor long, context long, doc long, tie long, start int, size int"
COLUMNS = ["kind", "anchor", "context", "doc", "tie", "start", "size"]
#: A repeat as a whole; a context that may still hold repeats.
REPEAT, OPEN = 1, 2

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(30))) * _B
    values = (values ^ (values >> np.uint64(27))) * _C
    return values ^ (values >> np.uint64(31))


def words_of_eight(data: np.ndarray) -> np.ndarray:
    """At every byte, it and the next seven as one integer (zeros after the end)."""
    wide = np.zeros(len(data) + 8, np.uint64)
    wide[:len(data)] = data
    for reach in (1, 2, 4):
        wide[:-reach] |= wide[reach:] << np.uint64(8 * reach)
    return wide[:len(data)]


def owned(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the least hash in any `window` consecutive ones, the first if tied; first and last start of each one's windows.

    The hashes of sequence i are `counts[i]` ones from `starts[i]`; windows lie inside sequences.
    A window has one such place, and the windows of a place are neighbours.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    tagged = np.full(-(-(n + window) // window) * window, np.iinfo(np.uint64).max, np.uint64)
    tagged[:n] = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    rows = tagged.reshape(-1, window)
    until = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[:n], until[window - 1:window - 1 + n])
    windows = np.maximum(counts - window + 1, 0)
    inside = np.zeros(n + 1, np.int32)
    np.add.at(inside, starts[windows > 0], 1)
    np.add.at(inside, (starts + windows)[windows > 0], -1)
    begins = np.flatnonzero(np.cumsum(inside[:n]) > 0)
    picked = (least[begins] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(picked):
        return picked, begins, begins
    turns = np.flatnonzero(picked[1:] != picked[:-1])
    return picked[np.append(0, turns + 1)], begins[np.append(0, turns + 1)], begins[np.append(turns, len(begins) - 1)]


def minimizers(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """The places that `owned` picks."""
    return owned(hashes, starts, counts, window)[0]


def ordered(docs: DataFrame) -> DataFrame:
    """(doc, tie, text) with the text as bytes; a null doc_id comes before all others, a null text is empty.

    A document is a doc_id and a text: `tie`, the text's hash, parts and orders texts of one id or of none.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).cast("long").alias("doc"), F.xxhash64(text).alias("tie"), text.alias("text"))


def numbered(doc: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of documents in the order of (doc, tie), and both by number."""
    order = np.lexsort((tie, doc))
    doc, tie = doc[order], tie[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])
    number = np.empty(len(doc), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, doc[new], tie[new]


def _first_rows(anchor, context, doc, tie, start, alone: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by (anchor, context, doc, tie, start): where contexts begin, which rows stay, and which are repeats.

    A row at the very place of the first one, of a repeated document, is neither.
    """
    n = len(anchor)
    begins = np.ones(n, bool)
    begins[1:] = (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])
    first = np.flatnonzero(begins)[np.cumsum(begins) - 1]
    same_doc = (doc == doc[first]) & (tie == tie[first])
    if alone:
        return begins, begins, ~(same_doc & (start == start[first]))
    return begins, same_doc, ~same_doc


def _merged(doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the spans of each document."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order].astype(np.int64), start[order].astype(np.int64) + size[order]
    if not len(doc):
        return doc, start, end
    turn = np.ones(len(doc), bool)
    turn[1:] = doc[1:] != doc[:-1]
    # The furthest end so far within a document, by lifting each document above the one before.
    lift = np.cumsum(turn) * np.int64(1 << 32)
    reach = np.maximum.accumulate(end + lift) - lift
    opens = turn.copy()
    opens[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(opens)
    return doc[at], start[at], np.maximum.reduceat(end, at)


def _batch(kind: int, anchor, context, doc, tie, start, size) -> pa.RecordBatch:
    return pa.record_batch([
        pa.array(np.full(len(doc), kind, np.int32)), pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)),
        pa.array(doc), pa.array(tie), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32))], COLUMNS)


def _spans(doc, tie, start, size) -> Iterator[pa.RecordBatch]:
    number, docs, ties = numbered(doc, tie)
    number, start, end = _merged(number, start, size)
    if len(number):
        doc, tie = docs[number], ties[number]
        spread = mixed(doc.view(np.uint64) + tie.view(np.uint64) + start.astype(np.uint64))
        yield _batch(REPEAT, spread, np.zeros(len(doc), np.uint64), doc, tie, start, end - start)


def _in_partition(contexts: Callable, alone: bool):
    """Contexts of a partition's documents, folded among themselves: rows to compare and repeats."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for block in blocks(batches, "text"):
            number, anchor, context, start, size = contexts(block.column("text"))
            found.append((np.asarray(block.column("doc"))[number], np.asarray(block.column("tie"))[number], anchor, context, start.astype(np.int32), size.astype(np.int32)))
        if not found:
            return
        doc, tie, anchor, context, start, size = (np.concatenate(x) for x in zip(*found))
        found.clear()
        order = np.lexsort((start, tie, doc))
        order = order[np.argsort(context[order], kind="stable")]
        doc, tie, anchor, context, start, size = doc[order], tie[order], anchor[order], context[order], start[order], size[order]
        _, stays, later = _first_rows(anchor, context, doc, tie, start, alone)
        yield from _spans(doc[later], tie[later], start[later], size[later])
        kept = np.flatnonzero(stays)
        for at in range(0, len(kept), 50_000):
            rows = kept[at:at + 50_000]
            yield _batch(OPEN, anchor[rows], context[rows], doc[rows], tie[rows], start[rows], size[rows])

    return run


def _across(alone: bool):
    """Fold rows sorted by (anchor, context, doc, tie, start); contexts that are alone at their anchor go."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the kept rows of the last context, and whether its anchor has several
        several = False
        for batch in batches:
            kind = np.asarray(batch.column("kind"))
            known = kind == REPEAT
            if known.any():
                yield batch.filter(pa.array(known))
            rows = [np.asarray(batch.column(c))[~known] for c in COLUMNS[1:]]
            n_held = 0
            if held is not None:
                n_held = len(held[0])
                rows = [np.concatenate(x) for x in zip(held, rows)]
            anchor, context, doc, tie, start, size = rows
            if not len(anchor):
                continue
            begins, stays, later = _first_rows(anchor, context, doc, tie, start, alone)
            yield from _spans(doc[later], tie[later], start[later], size[later])
            turn = np.ones(len(anchor), bool)
            turn[1:] = anchor[1:] != anchor[:-1]
            group = np.cumsum(turn) - 1
            many = np.bincount(group, begins) > 1
            many[0] |= several and n_held > 0
            last = len(anchor) - 1 - int(begins[::-1].argmax())  # where the last context begins
            opened = stays & many[group]
            opened[last:] = False
            yield from _open(rows, opened)
            held = [x[last:][stays[last:]] for x in rows]
            several = bool(many[group[last]])
        if held is not None and several:
            yield from _open(held, np.ones(len(held[0]), bool))

    return run


def _open(rows: list[np.ndarray], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    if chosen.any():
        yield _batch(OPEN, *(x[chosen] for x in rows))


def recurring(docs: DataFrame, contexts: Callable, alone: bool) -> DataFrame:
    """Repeats and open contexts of ordered documents, stored: see ROWS.

    `contexts` gives, for an array of texts, the text number, anchor hash, context hash, start
    and size of every anchor's context. `alone`: of equal contexts only the earliest stays,
    also within a document; otherwise all those of the earliest document stay. Each task folds
    its own contexts first, so a context comes from a task once and an anchor that any number
    of documents hold is met as often as there are tasks.
    """
    rows = docs.mapInArrow(_in_partition(contexts, alone), ROWS)
    dealt = rows.repartition("anchor").sortWithinPartitions("anchor", "context", "doc", "tie", "start")
    return keep(dealt.mapInArrow(_across(alone), ROWS), "recurring")


def cover(spans: list, n: int) -> list[tuple[int, int]]:
    """Maximal removed runs."""
    runs: list[list[int]] = []
    for start, end in sorted((x["start"], min(x["end"], n)) for x in spans or []):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        elif start < end:
            runs.append([start, end])
    return [tuple(x) for x in runs]


def applied(docs: DataFrame, spans: DataFrame, result: Callable, schema: str, types: tuple) -> DataFrame:
    """`result(text, spans)` of each ordered document, as doc_id and further columns; spans are None if it has none."""
    listed = spans.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    names = [x.split()[0] for x in schema.split(", ")]
    lowest = -(1 << 63)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            made = [result(raw, found) for raw, found in zip(block.column("text").to_pylist(), block.column("spans").to_pylist())]
            ids = pa.array([None if x == lowest else x for x in block.column("doc").to_pylist()], pa.int64())
            yield pa.record_batch([ids, *(pa.array(x, kind) for x, kind in zip(zip(*made), types))], names)

    return docs.join(listed, ["doc", "tie"], "left").select("doc", "text", "spans").mapInArrow(run, schema)

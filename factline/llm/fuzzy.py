"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes marks chunk boundaries; each chunk becomes one
12-bit letter, and the letters of a text at its block level and at the next one up form its
fingerprint. Two fingerprints are compared by edit distance (insertions and deletions) of
letter sequences taken at the same block level.

Defined cases: a null text counts as empty; equal texts have equal fingerprints and likeness
1; an empty text is like nothing but an empty text; repeated rows are fingerprinted alike.
Texts of any length are read whole: the level grows with the text until at least 64 chunks
remain, and there is no longest signature.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.llm.arrow import blocks, flat, padded

WINDOW = 7
LEAST_CHUNKS = 64
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
PAIRS = np.array([a + b for a in LETTERS for b in LETTERS])

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def rolling(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the last seven bytes at every byte."""
    plain, weighted, shifted = (np.zeros(len(data), np.uint32) for _ in range(3))
    wide = data.astype(np.uint32)
    for back in range(min(WINDOW, len(data))):
        earlier = wide[:len(data) - back]
        plain[back:] += earlier
        weighted[back:] += earlier * np.uint32(WINDOW - back)
        shifted[back:] ^= earlier << np.uint32(5 * back)
    mixed = (plain + weighted + shifted) * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    return mixed * np.uint32(0x85EBCA77)


def _powers(step: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, step, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _signature(ends: np.ndarray, sums: np.ndarray, back: np.ndarray, start: int, stop: int) -> str:
    """One letter for each chunk of [start, stop); ends: the places of the boundary bytes."""
    if stop == start:
        return ""
    cuts = ends + 1 if len(ends) and ends[-1] == stop - 1 else np.append(ends + 1, stop)
    froms = np.append(start, cuts[:-1])
    value = (sums[cuts] - sums[froms]) * back[froms - start]
    value = (value ^ (value >> np.uint64(32))) * _MIX
    return "".join(PAIRS[(value >> np.uint64(52)).astype(np.int64)])


def fingerprints(text: np.ndarray, offsets: np.ndarray) -> list[str]:
    """`level:signature:signature one level up` of each text."""
    data, starts = padded(text, offsets, WINDOW)
    lengths = np.diff(offsets)
    if not len(data):
        return ["0::"] * len(lengths)
    trigger = rolling(data)
    longest = int(lengths.max(initial=0)) + 1
    forward, back = _powers(_STEP, longest), _powers(_BACK, longest)
    made = []
    for start, n in zip(starts.tolist(), lengths.tolist()):
        stop = start + n
        own = trigger[start:stop]
        level = max(0, int(n // LEAST_CHUNKS).bit_length() + 1)
        places = np.zeros(0, np.int64)
        while level >= 0:
            places = np.flatnonzero(own < np.uint32(1 << (32 - level))) if level else np.arange(n)
            if len(places) >= LEAST_CHUNKS or not level:
                break
            level -= 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[start:stop].astype(np.uint64) + np.uint64(1)) * forward[:n], out=sums[1:])
        coarse = places[own[places] < np.uint32(1 << (31 - level))]
        made.append(f"{level}:{_signature(places, sums, back, 0, n)}:{_signature(coarse, sums, back, 0, n)}")
    return made


def _common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, all of `a` in one integer."""
    masks: dict[str, int] = {}
    for i, letter in enumerate(a):
        masks[letter] = masks.get(letter, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for letter in b:
        hit = row & masks.get(letter, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    x, y = [a[i:i + 2] for i in range(0, len(a), 2)], [b[i:i + 2] for i in range(0, len(b), 2)]
    return 2 * _common(x, y) / (len(x) + len(y))


def likeness(one: str, other: str) -> float:
    """1 less the edit distance over both lengths, at a block level that both have; 0 if none."""
    if one == other:
        return 1.0
    (k, fine, coarse), (j, other_fine, other_coarse) = one.split(":"), other.split(":")
    apart = int(k) - int(j)
    if apart == 0:
        return max(_alike(fine, other_fine), _alike(coarse, other_coarse))
    if apart == 1:
        return _alike(fine, other_coarse)
    if apart == -1:
        return _alike(coarse, other_fine)
    return 0.0


def fingerprint(text: Column) -> Column:
    """A column of fingerprints; null counts as empty."""

    @F.pandas_udf("string")
    def make(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            found = []
            for block in blocks([pa.record_batch([pa.array(part, pa.binary())], ["text"])], "text"):
                found += fingerprints(*flat(block.column("text")))
            yield pd.Series(found, dtype=object)

    return make(F.coalesce(text, F.lit("")).cast("binary"))


_PAIRED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def next_in_order(docs: DataFrame) -> DataFrame:
    """Deal documents out by descending id, with the first one of the following range as a guest at the end.

    The order is by doc_id, a null one as the lowest; rows that share an id are ordered by a
    hash of the text. Ranges come from quantiles of the ids, one for each shuffle partition,
    so the driver sees one id a range. Each text is shuffled once. Columns: `bucket`, `guest`,
    `doc_id`, `tie`, `text` (binary), sorted in that order within partitions.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(
        "doc_id", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("place"),
        F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    cuts = base.agg(F.percentile_approx("place", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def home(place: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(cuts, place.to_numpy(np.int64), side="right"))

    homed = base.withColumn("bucket", home("place"))
    heads = sorted((r["bucket"], r["head"]["place"], r["head"]["tie"]) for r in base.select("place", "tie").withColumn(
        "bucket", home("place")).groupBy("bucket").agg(F.max(F.struct("place", "tie")).alias("head")).collect())
    if not heads:
        return homed.select("bucket", F.lit(True).alias("guest"), "doc_id", "place", "tie", F.col("text").cast("binary"))
    follows = {heads[i][1:]: heads[i - 1][0] for i in range(len(heads))}
    table = spark.createDataFrame([(*key, bucket) for key, bucket in follows.items()], "place long, tie long, visits int")
    visits = homed.join(F.broadcast(table), ["place", "tie"], "left")  # at most one row a range
    stays = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    goes = F.struct(F.col("visits").alias("bucket"), F.lit(True).alias("guest"))
    return (visits.select("doc_id", "place", "tie", "text",
                          F.explode(F.when(F.col("visits").isNull(), F.array(stays)).otherwise(F.array(stays, goes))).alias("at"))
            .select("at.bucket", "at.guest", "doc_id", "place", "tie", F.col("text").cast("binary").alias("text"))
            .repartitionById(parts, F.col("bucket"))
            .sortWithinPartitions("bucket", "guest", F.desc("place"), F.desc("tie")))


def against_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against that of its edited text and that of the next document.

    The edited text has the last third of the code points replaced by as many (or all) from
    the start of the next document in descending doc_id, the first one following the last. A
    document without another is its own next one. Rows that share an id and a text follow
    each other. An empty table gives an empty result.
    """

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None  # bucket, id, text and fingerprint of the row that waits for its next one
        for block in blocks(batches, "text"):
            buckets, guests = block.column("bucket").to_pylist(), block.column("guest").to_pylist()
            ids, texts = block.column("doc_id").to_pylist(), block.column("text").to_pylist()
            own = fingerprints(*flat(block.column("text")))
            pairs = []
            for row in zip(buckets, guests, ids, texts, own):
                bucket, guest = row[:2]
                if held is not None and held[0] == bucket:
                    pairs.append((held, row))
                    if guest:  # further copies of the guest are not the next one of anything
                        held = None
                if not guest:
                    held = row
            if pairs:
                yield _compared(pairs)

    return next_in_order(docs).mapInArrow(compare, _PAIRED)


def _compared(pairs: list) -> pa.RecordBatch:
    edited, counts = [], []
    for one, following in pairs:
        text, other = one[3].decode(), following[3].decode()
        third = len(text) // 3
        counts.append(len(text))
        edited.append((text[:len(text) - third] + other[:third]).encode())
    prints = fingerprints(*flat(pa.array(edited, pa.binary())))
    return pa.record_batch([
        pa.array([one[2] for one, _ in pairs], pa.int64()), pa.array(counts, pa.int64()),
        pa.array([hashlib.sha256(x).hexdigest() for x in edited]), pa.array([one[4] for one, _ in pairs]), pa.array(prints),
        pa.array([likeness(one[4], x) for (one, _), x in zip(pairs, prints)], pa.float64()),
        pa.array([likeness(one[4], other[4]) for one, other in pairs], pa.float64()),
    ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

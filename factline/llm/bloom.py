"""Exact dedup by two passes over Bloom filters.

The first pass sets the bits of every row's hash and notes which bits a second row sets too;
what remains is a filter of the hashes that possibly repeat. The second pass asks that filter
about every row: a row whose bits are not all set twice is alone and goes straight through,
the other ones are stored and grouped by their whole key. A filter can call a lone row
repeated, never the other way round, so results are exact whatever its load.

The filter is cut into shards of 2**20 bits by the hash, `BITS_PER_ROW` bits for each row, so
a shard holds about as many rows at any size. Tasks send a shard the places of their bits,
each once a block, however often a text occurs. Executors get at most `filter_bytes` of
filter at a time; a table with more rows is asked in as many slices of the hash range, each
of which is a pass over the (narrow) columns given.

Groups of over a thousandth of the rows are at most a thousand, so their verdicts are
broadcast; other groups meet their rows in a shuffle on the key, which no key dominates.

Defined cases: a null text counts as empty. A null id is below every other one. Rows that
share the largest id of their group are told apart by their place in the stored table: one
of them stays. An empty table gives an empty result. Columns of the input whose names are
those of the made ones are replaced by these; all other names are free.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.llm.words import lowered
from factline.storage import keep

SHARD_BITS = 1 << 20
BITS_PER_ROW = 16
PROBES = 4
#: Filter that executors hold at a time.
FILTER_BYTES = 64 << 20
#: Hashes that a task turns into places of bits at a time.
BLOCK_ROWS = 1 << 18
#: Groups of more than this share of the rows are joined by broadcast: at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.001

_MIX = np.uint64(0x9E3779B97F4A7C15)


def places(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each 64-bit hash, and the places of its bits there, a row of PROBES each."""
    wide = hashes.astype(np.int64).view(np.uint64)
    shard = ((wide >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    mixed = wide * _MIX
    mixed ^= mixed >> np.uint64(29)
    first, step = mixed & np.uint64(0xFFFFFFFF), (mixed >> np.uint64(32)) | np.uint64(1)
    at = first[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)[None, :]
    return shard.astype(np.int64), (at % np.uint64(SHARD_BITS)).astype(np.int64)


def _set_once_and_twice(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each shard of a block: the places of set bits, and of those that two rows set."""
    shard, at = places(hashes, shards)
    whole = np.sort(shard[:, None] * SHARD_BITS + at, axis=1)
    fresh = np.ones(whole.shape, bool)  # a row that meets one of its own bits sets it once
    fresh[:, 1:] = whole[:, 1:] != whole[:, :-1]
    once, counts = np.unique(whole[fresh], return_counts=True)
    twice = once[counts > 1]
    for one in np.unique(once // SHARD_BITS).tolist():
        ends = [one * SHARD_BITS, (one + 1) * SHARD_BITS]
        a, b = (part[slice(*np.searchsorted(part, ends))] - ends[0] for part in (once, twice))
        yield one, a.astype(np.uint32), b.astype(np.uint32)


def repeat_filter(hashes: DataFrame, shards: int) -> DataFrame:
    """Rows `(shard, bits)` of the bits that two or more rows of the one column `hash` set."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(values), BLOCK_ROWS):
                found = list(_set_once_and_twice(values[start:start + BLOCK_ROWS], shards))
                yield pa.record_batch([
                    pa.array([one for one, _, _ in found], pa.int64()),
                    pa.array([a.tobytes() for _, a, _ in found], pa.binary()),
                    pa.array([b.tobytes() for _, _, b in found], pa.binary())], ["shard", "once", "twice"])

    def merge(parts: pa.Table) -> pa.Table:
        once, twice = np.zeros(SHARD_BITS, bool), np.zeros(SHARD_BITS, bool)
        for a, b in zip(parts.column("once"), parts.column("twice")):
            at = np.frombuffer(a.as_buffer(), np.uint32)
            twice[at[once[at]]] = True
            once[at] = True
            twice[np.frombuffer(b.as_buffer(), np.uint32)] = True
        return pa.table({"shard": parts.column("shard").slice(0, 1), "bits": pa.array([np.packbits(twice).tobytes()], pa.binary())})

    set_bits = hashes.mapInArrow(sets, "shard long, once binary, twice binary")
    return set_bits.groupBy("shard").applyInArrow(merge, "shard long, bits binary")


def _asks(df: DataFrame, filters: DataFrame, shards: int, first: int, last: int) -> Callable[[Column], Column]:
    """A test of hashes against the shards of [first, last), which executors get by broadcast."""
    bits = np.zeros((last - first, SHARD_BITS // 8), np.uint8)
    for row in filters.filter(F.col("shard").between(first, last - 1)).collect():  # at most filter_bytes
        bits[row["shard"] - first] = np.frombuffer(row["bits"], np.uint8)
    sent = df.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def ask(hashes: pd.Series) -> pd.Series:
        shard, at = places(hashes.to_numpy(np.int64), shards)
        inside = (shard >= first) & (shard < last)
        row = np.where(inside, shard - first, 0)
        held = sent.value[row[:, None], at >> 3] >> (7 - (at & 7)) & 1
        return pd.Series(inside & held.all(axis=1))

    return ask


def in_slice(hashed: Column, shards: int, first: int, last: int) -> Column:
    """Whether the shard of a hash is in [first, last)."""
    shard = F.shiftrightunsigned(F.shiftrightunsigned(hashed, 32) * F.lit(shards).cast("long"), 32)
    return shard.between(first, last - 1)


def mark(df: DataFrame, key: str, order: str, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Add `keep_id`, `group_size` and `kept` to rows: those of equal `key` are a group.

    The row with the largest `order` stays; `keep_id` is that value. `key` must not be null
    and is compared whole; `df` is read once for the filter and once a slice, so give it stored.
    """
    rows = df.count()
    shards = -(-rows * BITS_PER_ROW // SHARD_BITS) or 1
    per_slice = max(1, filter_bytes // (SHARD_BITS // 8))
    hashed = F.xxhash64(F.col(key))
    filters = keep(repeat_filter(df.select(hashed.alias("hash")), shards), "filter")
    made = ["keep_id", "group_size", "kept"]
    own = [F.col(f"row.`{name}`") for name in df.columns if name not in made]
    alone, possible = [], []
    for first in range(0, shards, per_slice):
        last = min(first + per_slice, shards)
        ask = _asks(df, filters, shards, first, last)
        asked = df.select(F.struct("*").alias("row"), hashed.alias("hash")).filter(in_slice(F.col("hash"), shards, first, last)).select(
            "row", ask(F.col("hash")).alias("possible"))
        alone.append(asked.filter(~F.col("possible")))
        possible.append(asked.filter("possible"))
    straight, repeated = _union(alone), _union(possible)
    repeated = keep(repeated.select(F.col(f"row.`{key}`").alias("key"), F.col(f"row.`{order}`").alias("at"),
                                    F.monotonically_increasing_id().alias("tie"), "row"), "repeated")
    groups = keep(repeated.groupBy("key").agg(F.max(F.struct("at", "tie")).alias("stays"), F.count(F.lit(1)).alias("size")), "groups")
    hot = F.col("size") > F.lit(int(rows * HOT_SHARE))
    verdicts = groups.select(F.col("key").alias("group"), "stays", "size")
    # At most a thousand groups hold over a thousandth of the rows each.
    known = repeated.join(F.broadcast(verdicts.filter(hot)), F.col("key") == F.col("group"), "left")
    met = known.filter(F.col("group").isNull()).drop("group", "stays", "size").join(
        verdicts.filter(~hot), F.col("key") == F.col("group"))
    ruled = [F.col("stays.at").alias("keep_id"), F.col("size").alias("group_size"), (F.col("stays.tie") == F.col("tie")).alias("kept")]
    lone = [F.col(f"row.`{order}`").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")]
    return straight.select(*own, *lone).unionByName(known.filter(F.col("group").isNotNull()).select(*own, *ruled)).unionByName(
        met.select(*own, *ruled))


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first


def verdicts(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; equal digests stand for equal
    texts. Texts are read and digested once and never shuffled.
    """
    digest = F.sha2(lowered(F.coalesce("text", F.lit(""))).cast("binary"), 256)
    slim = keep(docs.select("doc_id", digest.alias("text_sha256")), "digests")
    return mark(slim, "text_sha256", "doc_id", filter_bytes).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def unique_documents(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The documents that stay, with all their columns; texts that are alone are not shuffled."""
    digest = F.sha2(lowered(F.coalesce("text", F.lit(""))).cast("binary"), 256)
    held = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("at"), digest.alias("key"))
    return mark(held, "key", "at", filter_bytes).filter("kept").select("doc.*")

"""Runs of periodically repeated words, found by Kruskal over descending common prefixes.

The suffixes of a document's word numbers are sorted, and neighbours in that order are the
edges of a path, weighted by their common prefix. Edges are taken by decreasing weight, and
union-find joins the two classes that an edge links; a class keeps its positions in order.
When positions i < j become neighbours in a class by an edge of weight w, their own common
prefix is w. If j - i <= w the text repeats with period j - i from i to j + w; and if the word
before i does not continue that, this is a run, whole to both sides. Its period is the
smallest: a smaller one would have put another position between i and j before. A run whose
first repeat starts at j has its pair (i, j) become neighbours exactly once, so each run is
found once. Edges lighter than half the least length cannot seed a run and are left out.

Suffixes are sorted by doubling, in numpy, and stop as soon as all are told apart; only
edges of repeated passages reach union-find. A document is one unit of work; memory is about
200 bytes a word of the longest one.

Defined cases: a null text has no words. Repeated rows give equal results. Texts of any
length are read whole. Runs that overlap are all listed. Other columns are untouched.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.functions.once import once
from factline.llm.words import words

#: The least length of a run in words; its length is also twice its period at least.
SHORTEST = 12

RUNS = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _ranks(ids: np.ndarray, least: int) -> list[np.ndarray] | None:
    """Ranks of the words, pairs, fours, ... at each position, until all differ; None if no `least` words recur.

    Two positions have one rank only if as many whole words follow both and agree.
    """
    n, width = len(ids), 1
    base = max(n, int(ids.max()) + 1) + 1
    levels = [ids]
    while True:
        last = levels[-1]
        follows = np.zeros(n, np.int64)
        follows[:n - width] = last[width:].astype(np.int64) + 1
        keys = last.astype(np.int64) * base + follows
        order = np.argsort(keys)
        inner = keys[order]
        rank = np.empty(n, np.int32)
        rank[order] = np.concatenate(([0], np.cumsum(inner[1:] != inner[:-1], dtype=np.int32)))
        levels.append(rank)
        width *= 2
        if int(rank[order[-1]]) == n - 1:
            return None if width <= least else levels


def _edges(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The positions in suffix order, and the common prefix of each one with the one before."""
    n = len(levels[-1])
    order = np.empty(n, np.int64)
    order[levels[-1]] = np.arange(n)
    one, other = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 2, -1, -1):
        ranks, width = levels[level], 1 << level
        inside = np.flatnonzero(np.maximum(one, other) < n)
        same = inside[ranks[one[inside]] == ranks[other[inside]]]
        common[same] += width
        one[same] += width
        other[same] += width
    return order, common


def _linked(order: np.ndarray, common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, w): positions i < j that become neighbours in a class by an edge of weight w >= least."""
    chosen = np.flatnonzero(common >= least)
    chosen = chosen[np.argsort(-common[chosen], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for a, b, weight in zip(order[chosen].tolist(), order[chosen + 1].tolist(), common[chosen].tolist()):
        a, b = root(a), root(b)
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            large, small, a, b = small, large, b, a
        parent[b] = a
        if 16 * len(small) < len(large):
            for x in small:
                insort(large, x)
        else:
            large = sorted(large + small)
        members[a] = large
        new = set(small)
        for x in small:
            at = bisect_left(large, x)
            if at and large[at - 1] not in new:
                yield large[at - 1], x, weight
            if at + 1 < len(large) and large[at + 1] not in new:
                yield x, large[at + 1], weight


def runs_of(ids: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of word numbers, by start and period."""
    least = (shortest + 1) // 2
    if len(ids) < max(shortest, 2) or (levels := _ranks(ids.astype(np.int32), least)) is None:
        return []
    order, common = _edges(levels)
    found = []
    for i, j, weight in _linked(order, common, least):
        period = j - i
        if period <= weight and period + weight >= shortest and (i == 0 or ids[i - 1] != ids[j - 1]):
            found.append((i, period + weight, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def numbered(tokens: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(token, len(known)) for token in tokens), np.int64, len(tokens))


def collapsed(tokens: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words less those that a run repeats, joined by one space."""
    if not runs:
        return b" ".join(tokens)
    change = np.zeros(len(tokens) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    repeated = np.cumsum(change[:-1]) > 0
    return b" ".join(token for token, gone in zip(tokens, repeated.tolist()) if not gone)


def periodic_runs(text: Column, shortest: int = SHORTEST) -> Column:
    """A struct of the runs of a text by start and period, and of its words without what runs repeat."""

    @F.pandas_udf(RUNS)
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            listed, texts = [], []
            for body in part:
                tokens = body.encode().split()  # at [\x20\x09-\x0D]+
                runs = runs_of(numbered(tokens), shortest)
                listed.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                texts.append(collapsed(tokens, runs).decode())
            yield pd.DataFrame({"runs": pd.Series(listed, dtype=object), "collapsed": pd.Series(texts, dtype=object)})

    return find(F.coalesce(text, F.lit("")))


def with_planted_tail(docs: DataFrame) -> DataFrame:
    """`(doc_id, text)`; ids whose CRC-32 is divisible by 10 get their words with a periodic tail, a null id none."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    hit = F.coalesce(hashed % 10 == 0, F.lit(False))
    held = once(docs.select("doc_id", "text", F.floor(hashed / 10).alias("g"), F.when(hit, words(F.col("text"))).alias("w")),
                held=F.col("w"), n=F.greatest(F.size("w"), F.lit(1)))
    placed = once(held, a=(F.col("g") % F.col("n")).cast("int"))
    placed = once(placed, p=(F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int"))
    tail = F.transform(F.sequence("a", F.col("n") - 1), lambda i: F.get("held", F.col("a") + (i - F.col("a")) % F.col("p")))
    edited = F.array_join(F.concat(F.slice("held", F.lit(1), F.col("a")), tail), " ")
    return placed.select("doc_id", F.when(F.size("held") > 0, edited).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """One row per `(doc_id, text)`: how many runs, the longest one, and hashes of all runs and of the collapsed words."""
    found = docs.select("doc_id", periodic_runs(F.col("text"), shortest).alias("found"))
    runs = F.col("found.runs")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return once(found, best=best).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"), F.floor(F.lit(1000) * F.col("best.n") / -F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"))

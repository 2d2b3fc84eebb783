"""Exact dedup, periodic runs and manifests against plain versions."""

import hashlib
import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from brute import documents, saved  # noqa: E402, F401

from factline.llm import bloom, merkle, periodic, queries  # noqa: E402

Q = queries.QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# Exact dedup


def copies(seed=2, n=300):
    rng = random.Random(seed)
    texts = [brute.prose(rng, rng.randint(1, 20)) for _ in range(n)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(1000 + i, texts[i].upper() if i % 2 else texts[i]) for i in range(0, n, 7)]
    rows += [(2000 + i, "The hot text") for i in range(150)]
    return rows + [(3000, None), (3001, ""), (3002, "É"), (3003, "é"), (3004, "x" * 200_000), (3005, "X" * 200_000)]


def grouped(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[sha(ascii_lower(text or ""))].append(doc)
    return {(doc, max(g), len(g), doc == max(g), digest) for digest, g in groups.items() for doc in g}


@pytest.mark.parametrize("slices", [False, True])
def test_exact_dedup_agrees_with_brute_force(spark, documents, monkeypatch, slices):
    rows, filter_bytes = copies(), bloom.FILTER_BYTES
    if slices:  # some shards, one at a time
        monkeypatch.setattr(bloom, "BITS_PER_ROW", 4 * bloom.SHARD_BITS // len(rows))
        filter_bytes = 1
    got = {tuple(r) for r in bloom.verdicts(documents(*rows).repartition(7), filter_bytes).collect()}
    assert got == grouped(rows)


def test_the_filter_misses_no_repeat_and_few_lone_rows_pass(spark):
    rng = np.random.default_rng(4)
    lone, twice = (rng.integers(-(1 << 63), 1 << 63, n) for n in (60_000, 3_000))
    hashes = np.concatenate([lone, twice, twice])
    shards = 2
    table = spark.createDataFrame([(int(x),) for x in hashes], "hash long").repartition(5)
    bits = {r["shard"]: np.frombuffer(r["bits"], np.uint8) for r in bloom.repeat_filter(table, shards).collect()}

    def possible(values):
        shard, at = bloom.places(values, shards)
        return np.array([all(bits[s][p >> 3] >> (7 - (p & 7)) & 1 for p in row) for s, row in zip(shard.tolist(), at)])

    assert possible(twice).all()
    assert possible(lone).mean() < 0.02


def test_shards_agree_inside_and_outside_python(spark):
    values = [0, -1, 1 << 62, -(1 << 63), 123456789, -987654321012345]
    table = spark.createDataFrame([(v,) for v in values], "h long")
    own = bloom.places(np.array(values, np.int64), 37)[0].tolist()
    for first in range(0, 37, 5):
        got = [r[0] for r in table.select(bloom.in_slice(F.col("h"), 37, first, first + 5)).collect()]
        assert got == [first <= s < first + 5 for s in own]


def test_exact_dedup_of_null_ids_repeated_rows_and_no_rows(spark, documents):
    got = sorted(map(tuple, bloom.verdicts(documents((None, "a"), (None, "A"), (5, "b"), (5, "b"), (4, "B"), (None, "c"))).collect()), key=repr)
    by = defaultdict(list)
    for doc, keep, size, kept, digest in got:
        by[digest].append((doc, keep, size, kept))
    assert sorted(by[sha("a")], key=repr) == [(None, None, 2, False), (None, None, 2, True)]
    assert sorted(by[sha("b")]) == [(4, 5, 3, False), (5, 5, 3, False), (5, 5, 3, True)]
    assert by[sha("c")] == [(None, None, 1, True)]
    assert bloom.verdicts(documents()).collect() == []
    assert bloom.unique_documents(documents()).collect() == []


def test_unique_documents_keep_their_columns_whatever_their_names(spark, documents):
    names = ["row", "key", "at", "tie", "hash", "possible", "group", "stays", "size", "doc", "keep_id", "group_size", "kept", "shard"]
    docs = documents((1, "a"), (2, "A"), (3, "b"))
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    got = bloom.unique_documents(docs)
    assert got.columns == docs.columns
    kept = sorted((r.asDict() for r in got.collect()), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in kept] == [2, 3]
    assert all(r[name] == f"{name}{r['doc_id']}" for r in kept for name in names)
    marked = bloom.mark(docs, "text", "doc_id")
    assert sorted(marked.columns) == sorted(docs.columns) and marked.filter("kept").count() == 3


def test_lone_rows_are_not_shuffled(spark, documents):
    lines = bloom.mark(documents((1, "a"), (2, "b")), "text", "doc_id")._jdf.queryExecution().sparkPlan().toString().split("\n")
    start = next(i for i, line in enumerate(lines) if "Union" in line)
    stop = next(i for i, line in enumerate(lines) if i > start and "Scan" in line)
    straight = "".join(lines[start + 1:stop])
    assert "ArrowEvalPython" in straight and not any(word in straight for word in ("Exchange", "Join", "Aggregate", "Window"))


# Periodic runs


def runs(words, shortest=12):
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i:i + length]
            smaller = any(part[r:] == part[:-r] for r in range(1, q)) if j > i else True
            if j > i and length >= max(shortest, 2 * q) and not smaller:
                found.append((i, length, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_agree_with_brute_force():
    rng = random.Random(1)
    for case in range(1500):
        n = rng.randint(0, 60)
        words = [rng.randint(0, rng.randint(0, 3)) for _ in range(n)]
        if case % 3 == 0 and n:
            a = rng.randrange(n)
            p = 1 + (n - a) // (3 + rng.randint(0, 7))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        shortest = rng.choice([12, 12, 2, 5, 7])
        assert periodic.runs_of(np.array(words, np.int64), shortest) == runs(words, shortest)


def test_runs_of_long_texts():
    n = 120_000
    assert periodic.runs_of(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert periodic.runs_of(np.arange(n) % 7) == [(0, n, 7)]
    assert periodic.runs_of(np.concatenate([[9], np.arange(n) % 10_007 + 10])) == [(1, n, 10_007)]
    one, other = [0], [0, 1]
    while len(other) < 500:
        one, other = other, other + one
    assert periodic.runs_of(np.array(other)) == runs(other)


def digest_of(doc, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(lines), hashlib.sha256(kept).hexdigest())


def test_run_digests_agree_with_brute_force(spark, documents, saved):
    rows = brute.corpus() + [(5000 + i, brute.prose(random.Random(i), i % 60, 2)) for i in range(150)]
    rows += [(None, "a b " * 9), (7000, "x"), (7001, "a\tb c\x0bd " * 5 + "a b " * 13), (7002, "z " * 30 + "y z " * 30), (5000, "again " * 12)]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 10
    got = sorted(map(tuple, Q["op12_periodic_runs"](spark, saved(documents=documents(*rows))).collect()), key=repr)
    assert got == sorted((digest_of(*row) for row in rows), key=repr)
    assert any(r[1] for r in got)


def test_no_documents_have_no_runs(spark, documents):
    assert periodic.digests(periodic.with_planted_tail(documents())).collect() == []


# Manifests


def tree(hashes, arity):
    """Levels of a tree from its leaves up."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + arity])) for i in range(0, len(last), arity)])
    return levels


def steps(levels, at, arity):
    for level in levels[:-1]:
        start = at - at % arity
        run = level[start:start + arity]
        yield "".join(run[:at - start]), "".join(run[at - start + 1:])
        at //= arity


def manifest(rows, arity):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text) rows."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(enc, r)))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    order = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: tree([leaf(r) for r in order[s]], arity) for s in sources}
    top = tree([trees[s][-1][0] for s in sources], arity)
    out = []
    for place, s in enumerate(sources):
        for at, row in enumerate(order[s]):
            path = [*steps(trees[s], at, arity), *steps(top, place, arity)]
            now = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                now = (*row[:4], ascii_lower(row[4]))
            got = leaf(now)
            for left, right in path:
                got = sha(left + got + right)
            out.append((row[0], leaf(row), trees[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), got, got == top[-1][0]))
    return sorted(out, key=repr)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def shelf(seed=5):
    rng = random.Random(seed)
    rows = []
    for source, n in [("hot", 300), (None, 33), ("é", 17), ("Z", 16), ("a", 1), ("b", 2), ("", 5)] + [(f"s{i}", 3) for i in range(20)]:
        rows += [[None, source, rng.choice(["en", None]), rng.choice([1, None]), brute.prose(rng, rng.randint(0, 9))] for _ in range(n)]
    for i, row in enumerate(rows):
        row[0] = i * 7 % 2003
    rows[3][4] = rows[9][4] = None
    return [tuple(r) for r in rows] + [tuple(rows[0]), (None, "hot", "en", 1, "No id"), (None, "hot", "en", 1, "No id either"), (None, None, None, None, None)]


@pytest.mark.parametrize("arity", [16, 2, 3])
def test_manifests_agree_with_brute_force(spark, arity):
    rows = shelf() if arity == 16 else shelf()[280:345]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    for name in ("tree", "at", "hash", "load", "order", "path", "members", "_tree", "_at", "_part", "top"):
        docs = docs.withColumn(name, F.lit(name))
    got = sorted(map(tuple, merkle.verified(docs, arity).collect()), key=repr)
    want = manifest(rows, arity)
    assert got == want
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_small_manifests(spark):
    assert merkle.verified(spark.createDataFrame([], DOCS)).collect() == []
    for rows in ([(1, "a", "en", 3, "one")], [(1, None, None, None, None), (2, "b", "en", 0, "")]):
        got = sorted(map(tuple, merkle.verified(spark.createDataFrame(rows, DOCS)).collect()), key=repr)
        assert got == manifest(rows, 16)


def test_a_changed_row_changes_the_root(spark):
    rows = shelf()[:40]
    other = [*rows[:7], (*rows[7][:4], "changed"), *rows[8:]]
    roots = [merkle.verified(spark.createDataFrame(r, DOCS)).select("root").distinct().collect() for r in (rows, other)]
    assert len(roots[0]) == len(roots[1]) == 1 and roots[0] != roots[1]

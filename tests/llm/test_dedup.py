import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from brute import documents, saved  # noqa: E402, F401

from factline.llm import line_dedup, phrases, queries, recurring, simhash, substrings, suffixes  # noqa: E402
from factline.llm.graph import components  # noqa: E402

Q = queries.QUERIES


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_suffix_arrays_agree_with_sorting():
    rng = np.random.default_rng(3)
    for case in range(400):
        n = int(rng.integers(0, 40))
        text = rng.integers(1, int(rng.integers(2, 7)), n)
        if case % 3 == 0 and n:
            text = np.tile(text[:max(1, n // 3)], 3)
        text = np.append(text, 0)
        assert suffixes.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_common_prefixes():
    raw = np.frombuffer(b"abcabcabcxabcabcab" * 3, np.uint8)
    array = suffixes.suffix_array(np.append(raw.astype(np.int64) + 1, 0))
    found = suffixes.common_prefixes(recurring.words_of_eight(raw), array[1:], np.arange(len(raw)), 20)
    before = dict(zip(array[2:].tolist(), array[1:-1].tolist()))
    for i in range(len(raw)):
        a, b = raw[i:].tobytes(), raw[before[i]:].tobytes() if i in before else b""
        same = next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))
        # Past the end of the text all bytes count as zeros, so only whole-length agreement may read further.
        assert found[i] == min(same, 20) or same == min(len(a), len(b))


@pytest.mark.parametrize("shard", [substrings.SHARD_BYTES, 400])
def test_byte_strings_agree_with_brute_force(spark, documents, shard):
    rows = brute.corpus()
    got = by_id(substrings.digests(documents(*rows), shard_bytes=shard))
    assert len(got) == len(rows)
    for doc, (raw, gone) in brute.cut_bytes(rows).items():
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        assert tuple(got[doc])[1:] == (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("shard", [phrases.SHARD_WORDS, 60])
def test_phrases_agree_with_brute_force(spark, documents, shard):
    rows = brute.corpus(2)
    got = by_id(phrases.kept_words(documents(*rows), shard_words=shard))
    assert len(got) == len(rows)
    for doc, (words, gone) in brute.cut_words(rows).items():
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        assert tuple(got[doc])[1:] == (len(words), sum(gone), kept)


def test_dedup_of_odd_tables(spark, documents):
    """Empty tables, null and repeated ids, and no text that is long enough."""
    for run in (substrings.digests, phrases.kept_words, line_dedup.dedup_lines):
        assert run(documents()).count() == 0
        odd = run(documents((None, None), (1, ""), (1, ""), (2, "short")))
        assert sorted((r["doc_id"] is not None, r["doc_id"]) for r in odd.collect()) == [(False, None), (True, 1), (True, 1), (True, 2)]
    long = brute.prose(random.Random(5), 120)
    twice = substrings.digests(documents((1, long), (1, long), (2, long))).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in twice] == [0, 0, len(long.encode())]
    kept = substrings.kept_bytes(documents((1, long), (2, "x" + long))).orderBy("doc_id").collect()
    assert kept[1]["kept"] == b"x" and [tuple(s) for s in kept[1]["spans"]] == [(1, len(long.encode()) + 1)]


@pytest.mark.parametrize("shards", [(substrings.SHARD_BYTES, phrases.SHARD_WORDS), (400, 60)])
def test_texts_without_ids_or_with_one_id(spark, documents, shards):
    """Each text is a document of its own, ordered by its hash where the id does not tell."""
    rng = random.Random(21)
    passage = brute.prose(rng, 80)
    texts = [f"{brute.prose(rng, rng.randint(20, 120))} {passage if i % 2 else ''} {brute.prose(rng, 30)}" for i in range(24)]
    texts[7] = texts[6] + " " + texts[2]
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else 100 + i, t) for i, t in enumerate(texts)]
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])))
    ranked = list(enumerate(t for _, t in order))
    want = sorted((str(order[i][0]), sum(gone), bytes(b for b, g in zip(raw, gone) if not g)) for i, (raw, gone) in brute.cut_bytes(ranked).items())
    got = substrings.kept_bytes(documents(*rows), shard_bytes=shards[0]).collect()
    assert sorted((str(r["doc_id"]), sum(e - s for s, e in r["spans"]), bytes(r["kept"])) for r in got) == want
    want = sorted((str(order[i][0]), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode())
                  for i, (words, gone) in brute.cut_words(ranked).items())
    got = phrases.kept_words(documents(*rows), shard_words=shards[1]).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"], r["text"]) for r in got) == want
    assert sum(x[1] for x in want) > 500


def lines_by_hand(rows, least=40, docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    where = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            where.setdefault(key(line), set()).add(doc)
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= least and len(where[key(x)]) >= docs and doc != max(where[key(x)]))]
        out[doc] = len(lines), len(lines) - len(kept), "\n".join(kept)
    return out


@pytest.mark.parametrize("batches, fan_in", [(1, 2), (7, 2)])
def test_lines_agree_with_brute_force(spark, documents, batches, fan_in):
    rows = brute.corpus(4)
    docs = documents(*rows).repartition(6).withColumnRenamed("lang", "n_lines")
    out = line_dedup.dedup_lines(docs, batches=batches, fan_in=fan_in)
    assert out.columns == ["doc_id", "source", "n_chars", "text", "n_lines", "n_dropped"]
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()}
    assert got == lines_by_hand(rows) and sum(x[1] for x in got.values()) > 5


def test_runs_are_levelled(spark):
    runs = line_dedup.LineRuns(spark, fan_in=2)
    for batch in range(4):
        runs.add(spark.createDataFrame([(f"h{i}", batch) for i in range(batch + 2)], "line_hash string, doc_id long"))
    assert [len(level) for level in runs._levels] == [0, 0, 1]
    assert runs._stored().groupBy("line_hash").count().filter("count > 1").count() == 0
    found = {r["line_hash"]: (r["n_docs"], r["keeper"]) for r in runs.repeated(3).collect()}
    assert found == {"h0": (4, 3), "h1": (4, 3), "h2": (3, 3)}
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def fingerprint_by_hand(text, n=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints, radius):
    parent = {d: d for d in prints}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in prints:
        for b in prints:
            if bin(prints[a] ^ prints[b]).count("1") <= radius:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: root(d) for d in prints}


def test_simhash_groups_agree_with_brute_force(spark, documents, saved):
    rows = [(d, t) for d, t in brute.corpus(6, 60)] + [(1000 + i, "one two three four five " * 9 + str(i % 7)) for i in range(40)]
    found = by_id(Q["op10_simhash_groups"](spark, saved(documents=documents(*rows))))
    prints = {d: fingerprint_by_hand(t) for d, t in rows}
    assert {d: int(r["fingerprint"], 16) for d, r in found.items()} == prints
    assert {d: r["component_id"] for d, r in found.items()} == groups_by_hand(prints, 2)


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
def test_links_at_any_radius(spark, radius, monkeypatch):
    """Dense clusters and loners; small blocks make buckets meet in pairs."""
    monkeypatch.setattr(simhash, "LIMIT", 16)
    rng = random.Random(radius)
    values = {rng.getrandbits(64) for _ in range(150)}
    for centre in list(values)[:5]:
        values |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 2))) for _ in range(40)}
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    table = spark.createDataFrame([(v, v) for v in signed.values()], "fp long, node long")
    found = {r["node"]: r["component"] for r in components(simhash.links(table, radius, radius)).collect()}
    want = groups_by_hand(dict(zip(signed.values(), values)), radius)
    least = {}
    for node, group in want.items():
        least[group] = min(least.get(group, node), node)
    assert {n: found.get(n, n) for n in want} == {n: least[g] for n, g in want.items()}


def test_near_copies_leave_one(spark, documents):
    rng = random.Random(8)
    base = [brute.prose(rng, 300) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(6):
        words = base[i].split(" ")
        for at in rng.sample(range(300), 4):
            words[at] = f"edit{at}"
        rows += [(100 + i, " ".join(words)), (200 + i, base[i])]
    rows += [(300, ""), (301, None), (300, "")]
    docs = documents(*rows).withColumn("fp", F.lit(5)).withColumn("component_id", F.lit(6))
    kept = simhash.first_of_groups(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(12), 300]
    assert simhash.first_of_groups(documents()).count() == 0


def at_similarity(rng, common, own):
    """Two texts of `common` shingles that both have, and `own` ones of each."""
    words = [f"w{rng.getrandbits(40)}" for _ in range(common + 4)]
    return [" ".join(words + [f"{side}{rng.getrandbits(40)}" for _ in range(own)]) for side in "ab"]


def jaccard(a, b, n=5):
    one, other = ({tuple(t.split()[i:i + n]) for i in range(len(t.split()) - n + 1)} for t in (a, b))
    return len(one & other) / len(one | other)


@pytest.mark.parametrize("most", [simhash.MOST_SHINGLES, 500])
def test_near_copies_by_exact_similarity(spark, documents, most, monkeypatch):
    """Pairs at 0.75 both stay; of pairs at 0.8 and 0.85 the first stays; blocks of groups meet in pairs."""
    monkeypatch.setattr(simhash, "MOST_SHINGLES", most)
    rng = random.Random(11)
    rows, want = [], set()
    for at, (common, own, similarity) in enumerate([(300, 50, 0.75), (320, 40, 0.8), (340, 30, 0.85)] * 40):
        first, second = at_similarity(rng, common, own)
        assert jaccard(first, second) == similarity
        rows += [(2 * at, first), (2 * at + 1, second)]
        want |= {2 * at} if similarity >= 0.8 else {2 * at, 2 * at + 1}
    assert {r["doc_id"] for r in simhash.first_of_groups(documents(*rows)).collect()} == want


def test_near_copies_keep_one_a_group_not_an_id(spark, documents):
    """Rows without an id, and rows that share one, are documents of their own."""
    rng = random.Random(13)
    none, other, one, two = (brute.prose(rng, 200) for _ in range(4))
    rows = [(None, none), (None, none), (None, other), (7, one), (7, two), (8, two), (None, one)]
    kept = simhash.first_of_groups(documents(*rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(None, none), (None, other), (7, one), (7, two)], key=repr)


def test_similar_forest():
    sets = [np.array(x, np.uint64) for x in ([1, 2, 3, 4, 5], [2, 3, 4, 5], [2, 3, 4, 9], [7], [2, 3, 4, 5, 6])]
    assert sorted(map(tuple, map(sorted, zip(*simhash.similar_forest(sets, 0.8))))) == [(0, 1), (1, 4)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    random.Random(1).shuffle(chain)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

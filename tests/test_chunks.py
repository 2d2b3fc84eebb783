from random import Random

import pytest
from conftest import rows

from factline.operators import chunks
from factline.sources import knowledge


def envelope(kid, page, ids, total, success=True):
    data = [{"id": i, "knowledge_id": kid, "chunk_index": n, "content": f"body {i}"} for n, i in enumerate(ids)]
    return {"knowledge_id": kid, "page": page, "success": success, "total": total, "data": data}


def landed(spark, envelopes):
    return spark.createDataFrame(envelopes, chunks.ENVELOPE_SCHEMA)


def read_pages(pages, requested=None):
    """The reading loop, one page after the other."""
    have, seen, total, warned, ended, last = {}, 0, None, set(), False, 0
    for number in range(1, 1000):
        page = pages.get(number)
        if page is None:
            break
        last = number
        ids, declared = page
        if declared is not None and declared >= 0:
            if total is not None and total != declared:
                warned.add("changed")
            total = declared
        added = 0
        for i in ids:
            if i not in have:
                have[i] = number
                added += 1
        seen += len(ids)
        if requested and requested <= set(have):
            break
        if not ids or (total is not None and seen >= total):
            ended = total is None and not ids or total is not None and len(have) == total
            break
        if not added:
            warned.add("repeated")
            break
    return {"pages": last, "seen": seen, "distinct": len(have), "total": total, "changed": "changed" in warned,
            "repeated": "repeated" in warned, "complete": ended and not warned, "ids": set(have)}


def random_documents(seed):
    random = Random(seed)
    documents = {}
    for d in range(40):
        size, pages, made = random.choice([1, 2, 3]), {}, 0
        count = random.randrange(1, 7)
        for p in range(1, count + 1):
            if random.random() < 0.15 and p > 1:
                ids = list(pages[p - 1][0])
            elif random.random() < 0.1:
                ids = []
            else:
                ids = [f"d{d}-{made + k}" for k in range(size)]
                made += size
            total = random.choice([None, size * count, size * count, made + 1, -1])
            pages[p] = (ids, total)
        if random.random() < 0.2 and count > 2:
            del pages[random.randrange(2, count + 1)]
        documents[f"d{d}"] = pages
    return documents


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_completeness_replays_the_reading_loop(spark, seed):
    documents = random_documents(seed)
    df = landed(spark, [envelope(k, p, *page) for k, pages in documents.items() for p, page in pages.items()])
    got = {r["knowledge_id"]: r for r in chunks.completeness(df, block=2).collect()}
    read = chunks.assemble(df, block=2).select("knowledge_id", "chunk_id").collect()
    assert set(got) == {k for k, pages in documents.items() if 1 in pages}
    for k, pages in documents.items():
        if k not in got:
            continue
        want, r = read_pages(pages), got[k]
        assert (r["fetched_pages"], r["seen"], r["distinct_chunks"], r["total"]) == (want["pages"], want["seen"], want["distinct"], want["total"]), k
        assert (r["total_changed"], r["repeated"], r["complete"]) == (want["changed"], want["repeated"], want["complete"]), (k, pages)
        assert {c["chunk_id"] for c in read if c["knowledge_id"] == k} == want["ids"]


@pytest.mark.parametrize("seed", [4, 5])
def test_requested_chunks_replay_the_reading_loop(spark, seed):
    documents = random_documents(seed)
    df = landed(spark, [envelope(k, p, *page) for k, pages in documents.items() for p, page in pages.items()])
    random = Random(seed)
    wanted = {k: set(random.sample(sorted(set().union(*(p[0] for p in pages.values()))), 1))
              for k, pages in documents.items() if any(p[0] for p in pages.values())}
    requested = spark.createDataFrame([(k, i) for k, ids in wanted.items() for i in ids], "knowledge_id string, chunk_id string")
    got = {(r["knowledge_id"], r["chunk_id"]) for r in chunks.assemble(df, requested, block=2).collect()}
    want = set()
    for k, ids in wanted.items():
        have = read_pages(documents[k], ids)["ids"] if 1 in documents[k] else set()
        want |= {(k, i) for i in ids & have}
    assert got == want


def test_fixture_cases(spark):
    df = landed(spark, [
        envelope("whole", 1, ["c1", "c2"], 3), envelope("whole", 2, ["c3"], 3), envelope("empty", 1, [], 0),
        envelope("again", 1, ["c1"], 5), envelope("again", 2, ["c1"], 5)])
    got = {r["knowledge_id"]: (r["distinct_chunks"], r["complete"], r["warnings"]) for r in chunks.completeness(df).collect()}
    assert got == {"whole": (3, True, ""), "empty": (0, True, ""), "again": (1, False, f"{chunks.REPEATED} {chunks.PARTIAL}")}
    requested = spark.createDataFrame([("whole", "c2"), ("whole", "gone")], "knowledge_id string, chunk_id string")
    assert rows(chunks.missing(df, requested)) == [("whole", "gone")]
    assert rows(chunks.assemble(df, requested.filter("chunk_id = 'c2'")), "chunk_id") == [("c2",)]


def test_bad_envelopes(spark):
    foreign = envelope("k", 2, ["a"], 1)
    foreign["data"][0]["knowledge_id"] = "other"
    hollow = envelope("k", 3, ["a"], 1)
    hollow["data"][0]["content"] = None
    df = landed(spark, [envelope("k", 1, ["a"], 1), foreign, hollow, envelope("k", 4, [], 0, success=False)])
    assert rows(chunks.bad_envelopes(df), "page") == [(2,), (3,), (4,)]


def test_order_and_documents(spark, tmp_path):
    import json

    page = envelope("k", 1, ["a", "b", "c"], 3)
    for chunk, index in zip(page["data"], (2, None, 0)):
        chunk["chunk_index"] = index
    (tmp_path / "pages.json").write_text(json.dumps(page) + "\n")
    (tmp_path / "documents.json").write_text("\n".join(json.dumps(d) for d in (
        {"success": True, "data": {"id": "k", "knowledge_base_id": "kb", "file_name": "f.md", "description": "a summary"}},
        {"success": True, "data": {"id": "x", "knowledge_base_id": "other", "title": "t"}})))
    pages = knowledge.load_envelopes(spark, str(tmp_path / "pages.json"))
    documents = knowledge.load_documents(spark, str(tmp_path / "documents.json"), ["kb"])
    assert rows(documents) == [("k", "f.md", "a summary")]
    ordered = [r["chunk_id"] for r in chunks.in_order(chunks.assemble(pages)).collect()]
    assert ordered == ["b", "c", "a"]
    joined = chunks.with_documents(chunks.assemble(pages), documents)
    assert all("summary" not in r["content"] and r["title"] == "f.md" for r in joined.collect())


def test_marker_status(spark):
    one, two = "12345678-1234-1234-1234-123456789012", "aaaaaaaa-1234-1234-1234-123456789012"
    page = envelope("k", 1, ["a", "b"], 2)
    page["data"][0]["content"] = f"see NOTE:{one} and note:{two} and NOTE:{one}"
    df = chunks.assemble(landed(spark, [page, envelope("n", 1, ["z"], 1)]))
    found = chunks.markers(df, "NOTE")
    assert rows(found, "artifact_id", "nth") == [(one, 0), (two, 1)]
    documents = spark.createDataFrame([("k",), ("n",)], "knowledge_id string")
    index = spark.createDataFrame([(one, "s1", None), (one, "s2", "hash mismatch")], "artifact_id string, store_alias string, problem string")
    assert rows(chunks.marker_status(documents, found, index)) == sorted([
        ("k", one, "loaded", "s1"), ("k", one, "hash mismatch", None), ("k", two, "unavailable", None), ("n", None, "no_marker", None)], key=repr)

"""The stream of knowledge pages against the batch operator."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_chunks import envelope, landed, random_documents

from factline.operators import chunks
from factline.streaming.pages import follow_pages, land_in, latest

SAME = ["knowledge_id", "fetched_pages", "seen", "distinct_chunks", "total", "total_changed", "repeated", "complete", "warnings"]


def put(folder, name, envelopes):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in envelopes))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_and_order_equals_the_batch_result(spark, tmp_path, seed):
    rng = random.Random(seed)
    every = [envelope(k, p, *page) for k, pages in random_documents(seed).items() for p, page in pages.items()]
    dealt = every + rng.sample(every, 20)  # some pages come twice
    rng.shuffle(dealt)
    cut = [dealt[i::5] for i in range(5)]
    for i in range(3):
        put(tmp_path / "in", f"{i}.json", cut[i])
    args = (spark, str(tmp_path / "in"), str(tmp_path / "progress"), land_in(str(tmp_path / "out")))
    follow_pages(*args, files_per_batch=1)
    first = {int(p.name.split("=")[1]) for p in (tmp_path / "out").glob("batch=*")}
    sofar = landed(spark, [e for part in cut[:3] for e in part])
    assert rows(latest(spark, str(tmp_path / "out")), *SAME) == rows(chunks.completeness(sofar), *SAME)
    follow_pages(*args)  # nothing new
    assert {int(p.name.split("=")[1]) for p in (tmp_path / "out").glob("batch=*")} == first
    for i in (3, 4):
        put(tmp_path / "in", f"{i}.json", cut[i])
    follow_pages(*args, files_per_batch=2)
    assert rows(latest(spark, str(tmp_path / "out")), *SAME) == rows(chunks.completeness(landed(spark, every)), *SAME)
    # A status is emitted once for each batch that reads on, never for what an earlier run read.
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.groupBy("knowledge_id", "fetched_pages").count().filter("count > 1").count() == 0


def test_quiet_documents_are_given_up(spark, tmp_path):
    args = (spark, str(tmp_path / "in"), str(tmp_path / "progress"), land_in(str(tmp_path / "out")))
    put(tmp_path / "in", "0.json", [envelope("quiet", 1, ["a"], 5), envelope("quiet", 3, ["c"], 5), envelope("done", 1, ["x"], 1)])
    follow_pages(*args, quiet_ms=1)
    put(tmp_path / "in", "1.json", [envelope("other", 1, ["y"], 2)])
    follow_pages(*args, quiet_ms=1)
    put(tmp_path / "in", "2.json", [envelope("quiet", 2, ["b"], 5)])
    follow_pages(*args, quiet_ms=1)
    got = {r["knowledge_id"]: (r["fetched_pages"], r["complete"], r["stopped"], r["given_up"]) for r in latest(spark, str(tmp_path / "out")).collect()}
    assert got["quiet"] == (1, False, False, True) and got["done"] == (1, True, True, False) and got["other"][:2] == (1, False)


def test_a_page_that_breaks_the_rules_fails_the_stream(spark, tmp_path):
    put(tmp_path / "in", "0.json", [envelope("k", 1, ["a"], 1, success=False)])
    with pytest.raises(Exception, match="response invalid: failure reported"):
        follow_pages(spark, str(tmp_path / "in"), str(tmp_path / "progress"), land_in(str(tmp_path / "out")))


def test_checked_pages_pass(spark):
    df = landed(spark, [envelope("k", 1, ["a"], 1)])
    assert chunks.checked(df).agg(F.count("*")).first()[0] == 1

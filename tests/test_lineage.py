"""Closures of edges against a search by hand, and what a workspace records."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from factline.operators import lineage
from factline.plans.ingest import PipelineSpec
from factline.plans.workspace import Workspace
from factline.storage import work_folder

COPY = PipelineSpec(id="copy", version="1", steps=[("facts", "SELECT item, value FROM {t}")], outputs={"totals": "facts"})


def searched(edges, starts, up=False):
    found = set()
    for start in {s for s in starts if s is not None}:
        seen, latest, distance = {start}, {start}, 0
        while latest:
            distance += 1
            latest = {(b, a)[up] for a, b in edges if None not in (a, b) and (a, b)[up] in latest} - seen
            seen |= latest
            found |= {(start, node, distance) for node in latest}
    return found


def closure(spark, edges, starts, up=False):
    made = lineage.reach(spark.createDataFrame(edges, lineage.EDGES), spark.createDataFrame([(s,) for s in starts], "node string"), up)
    return [tuple(r) for r in made.collect()]


@pytest.mark.parametrize("seed, up", [(1, False), (2, True)])
def test_closure_equals_a_search(spark, seed, up):
    rng = random.Random(seed)
    nodes = [*"abcdefghij", None, ""]
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(16)]  # loops, repeats and nulls among them
    starts = ["a", "b", "b", "gone", None, ""]
    got = closure(spark, edges, starts, up)
    assert len(got) == len(set(got)) and set(got) == searched(edges, starts, up)


def test_chain_of_thirty_and_nothing_at_all(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(30)]
    assert set(closure(spark, chain, ["n0"])) == {("n0", f"n{i}", i) for i in range(1, 31)}
    assert closure(spark, [], ["a"]) == [] and closure(spark, chain, []) == []


def chained(rng, name):
    """Edges of chains that cross, merge, turn back and close to rings, most nodes having one edge onwards."""
    nodes = [f"{name}{i}" for i in range(24)]
    edges = [(a, b) for a, b in zip(nodes, nodes[1:]) if rng.random() < 0.9]
    edges += [(rng.choice(nodes), rng.choice(nodes)) for _ in range(rng.randrange(8))]
    ring = [f"{name}r{i}" for i in range(rng.randrange(1, 7))]
    return edges + [*zip(ring, ring[1:] + ring[:1]), (rng.choice(nodes), ring[0])], rng.sample(nodes, 3) + [ring[-1]]


@pytest.mark.parametrize("segment, up", [(1, False), (3, False), (3, True), (1024, False), (1024, True)])
def test_crossing_chains_equal_a_search(spark, monkeypatch, segment, up):
    monkeypatch.setattr(lineage, "SEGMENT", segment)
    graphs = [chained(random.Random(seed), f"g{seed}.") for seed in range(40)]
    edges, starts = ([x for graph in graphs for x in graph[i]] for i in (0, 1))
    got = closure(spark, edges, starts, up)
    assert len(got) == len(set(got))
    assert set(got) == {row for edges, starts in graphs for row in searched(edges, starts, up)}


def test_rounds_do_not_grow_with_the_length_of_a_chain(spark):
    rounds = lambda: set(Path(work_folder(spark).removeprefix("file:")).glob("lineage*/*=*"))
    before = rounds()
    assert len(closure(spark, [(f"n{i}", f"n{i + 1}") for i in range(60)], ["n0"])) == 60
    assert 0 < len(rounds() - before) < 20


def test_names_of_one_hash_are_told_apart(spark, monkeypatch):
    hashed = lineage._number
    monkeypatch.setattr(lineage, "_number", lambda name, salt: F.pmod(hashed(name, salt), F.lit(2)) if salt < 2 else hashed(name, salt))
    edges = [("a", "b"), ("b", "c"), ("x", "y"), ("c", "d"), ("c", "e")]
    assert set(closure(spark, edges, ["a", "gone"])) == searched(edges, ["a", "gone"])


def test_operations_recorded_again_replace_their_edges(spark, tmp_path):
    folder = str(tmp_path / "edges")
    assert lineage.recorded(spark, folder).count() == 0
    for made in ([("a", "b")], [("a", "c")]):
        lineage.record(spark.createDataFrame(made, lineage.EDGES), folder, "one")
    lineage.record(spark.createDataFrame([("c", "d")], lineage.EDGES), folder, "two")
    assert sorted(map(tuple, lineage.recorded(spark, folder).collect())) == [("a", "c"), ("c", "d")]


def test_what_rests_on_an_asset_after_a_restore(spark, tmp_path):
    for name in ("one", "two"):
        spark.createDataFrame([("A", 1)], "item string, value int").coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    root = str(tmp_path / "store")
    work = Workspace(spark, root)
    work.load_file(str(tmp_path / "one.parquet"), "t", glob="*.parquet")
    work.load_file(str(tmp_path / "two.parquet"), "u", glob="*.parquet")
    mine, other = (work.assets.filter(f"path LIKE '%/{n}.parquet/%'").first()["asset_id"] for n in ("one", "two"))
    first = work.sql("SELECT item, value + 1 AS value FROM T", name="v")
    with pytest.raises(Exception):
        work.sql("SELECT no_such_column FROM t")
    unrelated = work.sql("SELECT * FROM u")
    saved = work.checkpoint(["u", "v"])

    again = Workspace(spark, root)
    again.restore(saved)
    last = again.sql("SELECT sum(value) AS total FROM v", name="w")
    nodes = lambda made: {r["node"] for r in made.collect()}
    found = nodes(again.depends_on([f"asset:{mine}"]))
    assert {f"result:{first}", f"checkpoint:{saved}/v", f"result:{last}", again._node("v"), again._node("w")} <= found
    assert f"result:{unrelated}" not in found and f"checkpoint:{saved}/u" not in found and again._node("u") not in found
    above = nodes(again.depends_on(["table:w"], up=True))
    assert f"asset:{mine}" in above and work._node("t") in above and f"asset:{other}" not in above
    # A failed operation leaves no edges: what rests on `t` are `v` and what came of it.
    assert sum(n.startswith("operation:") for n in nodes(work.depends_on(["table:t"]))) == 2


def test_runs_and_artifacts_are_traced(spark, tmp_path):
    work = Workspace(spark, str(tmp_path / "store"))
    work.add("t", spark.createDataFrame([("A", 1)], "item string, value int"))
    run = work.pipeline(COPY, ["t"])
    work.load_artifact("mine", run["artifact_id"])
    found = {r["node"]: r["distance"] for r in work.depends_on(["table:t"]).collect()}
    assert found[f"artifact:{run['artifact_id']}"] == 2 and found[work._node("mine_totals")] == 4
    assert found[work._node(f"{run['prefix']}_totals")] == 2

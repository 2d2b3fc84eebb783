import glob
import json
import os
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from factline.operators.checks import ContractError
from factline.operators.versions import recipe_hash
from factline.plans import checkpoints, ingest
from factline.plans.results import preview, rows_for_person, store_result, unique_names
from factline.plans.workspace import Workspace
from factline.sources import artifacts, database
from factline.streaming.arrivals import take_arrivals

PACKAGE = {"id": "p", "version": "1", "digest": "d" * 64}
FACTS = "item string, value double, category string, evidence_id string, asset_id string"


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([("A", 10.0, None, "a:2", "a"), ("B", 20.0, None, "a:3", "a")], FACTS)


def publish(spark, tables, root, recipe=None):
    recipe = recipe or {"n": 1}
    return artifacts.publish(spark, tables, root, "scope", recipe, recipe_hash(recipe), PACKAGE)


def change_one_file(spark, pattern, other):
    """Put other bytes, with a fitting file-system checksum, in the place of one part file."""
    path = sorted(glob.glob(pattern, recursive=True))[0]
    spark.range(3).coalesce(1).write.parquet(other)
    source = glob.glob(f"{other}/part-*.parquet")[0]
    for old, new in ((source, path), (crc(source), crc(path))):
        shutil.copyfile(old, new)


def crc(path):
    folder, name = os.path.split(path)
    return os.path.join(folder, f".{name}.crc")


def test_artifact_round_trip_and_tampering(spark, facts, tmp_path):
    root = str(tmp_path)
    manifest = publish(spark, {"facts": facts}, root)
    loaded = artifacts.load(spark, root, manifest["artifact_id"], "scope")["facts"]
    assert rows(loaded) == rows(facts) and loaded.schema == facts.schema
    assert artifacts.find(spark, root, recipe_hash({"n": 1})) == manifest["artifact_id"]
    assert artifacts.find(spark, root, recipe_hash({"n": 2})) is None
    with pytest.raises(ContractError, match="scope mismatch"):
        artifacts.verify(spark, root, manifest["artifact_id"], "other")
    change_one_file(spark, f"{root}/data/{manifest['artifact_id']}/outputs/**/*.parquet", str(tmp_path / "other"))
    with pytest.raises(ContractError, match="hash mismatch"):
        artifacts.verify(spark, root, manifest["artifact_id"], "scope")


def test_folder_digest(spark, tmp_path):
    (tmp_path / "p" / "sub").mkdir(parents=True)
    (tmp_path / "p" / "sub" / "a.sql").write_text("SELECT 1")
    first = artifacts.folder_digest(spark, str(tmp_path / "p"))
    (tmp_path / "p" / "sub" / "a.sql").write_text("SELECT 2")
    assert first != artifacts.folder_digest(spark, str(tmp_path / "p"))


def test_failure_publishes_nothing(spark, facts, tmp_path):
    root = str(tmp_path)
    broken = facts.withColumn("value", F.raise_error(F.lit("stop")).cast("double"))
    with pytest.raises(Exception, match="stop"):
        publish(spark, {"facts": broken}, root)
    with pytest.raises(ContractError):
        publish(spark, {"documents": facts}, root)
    assert artifacts.index(spark, root).count() == 0


def test_image_bytes_round_trip(spark, tmp_path):
    root, bytes_ = str(tmp_path), bytes.fromhex("89504e470d0a1a0a00")
    images = spark.createDataFrame([("ref-1", "p1", "image/png")], "original_ref string, path string, mime_type string")
    files = spark.createDataFrame([("p1", bytes_)], "path string, content binary")
    manifest = publish(spark, artifacts.image_outputs(images, files), root)
    loaded = artifacts.load(spark, root, manifest["artifact_id"], "scope")
    assert loaded["images"].first()["path"].endswith("image_bytes#ref-1")
    assert bytes(loaded["image_bytes"].first()["content"]) == bytes_
    for content, mime in ((b"no image", "image/png"), (bytes_, "image/jpeg"), (bytes_, "image/tiff")):
        wrong = artifacts.image_outputs(images.withColumn("mime_type", F.lit(mime)), files.withColumn("content", F.lit(content)))
        with pytest.raises(ContractError, match="images"):
            publish(spark, wrong, root, {"n": 2})
    assert artifacts.index(spark, root).count() == 1
    manifest = publish(spark, {"images": images}, root, {"n": 3})
    with pytest.raises(ContractError, match="byte mapping"):
        artifacts.load(spark, root, manifest["artifact_id"], "scope")


def test_checkpoint_round_trip_and_tampering(spark, facts, tmp_path):
    root = str(tmp_path)
    saved = checkpoints.save(spark, {"facts": facts}, root, "scope", {"facts": {"kind": "sql"}})
    assert checkpoints.restore(spark, root, saved, "scope")["facts"].agg(F.sum("value")).first()[0] == 30.0
    assert rows(checkpoints.listing(spark, root)) == [(saved,)]
    with pytest.raises(ContractError, match="scope"):
        checkpoints.restore(spark, root, saved, "other")
    with pytest.raises(ContractError, match="not found"):
        checkpoints.restore(spark, root, "gone", "scope")
    change_one_file(spark, f"{root}/checkpoints/data/{saved}/outputs/**/*.parquet", str(tmp_path / "other"))
    with pytest.raises(ContractError, match="hash mismatch"):
        checkpoints.restore(spark, root, saved, "scope")


def test_result_pages(spark):
    result = store_result(spark.range(0, 57, 1, 5).select(((F.col("id") * 13) % 57).alias("n")), order=["n"])
    assert result.total_rows() == 57
    for offset, limit in ((0, 1), (0, 20), (19, 30), (50, 20), (56, 1), (57, 5)):
        got = [tuple(r) for r in result.page(offset, limit).orderBy("_row").collect()]
        assert got == [(n, n) for n in range(57)][offset:offset + limit]
    page = result.read(0, 1)
    assert (page["rows"], page["next_offset"], page["truncated"], page["total_rows"]) == ([{"n": 0}], 1, True, 57)
    last = result.read(40, 100)
    assert (len(last["rows"]), last["next_offset"], last["truncated"]) == (17, None, False)
    for bad in ((-1, 5), (0, 0), (0, 101)):
        with pytest.raises(ValueError):
            result.page(*bad)


def test_oversized_rows(spark):
    df = spark.sql("SELECT id, repeat('x', CASE WHEN id = 1 THEN 80000 ELSE 10 END) AS payload FROM range(3)")
    result = store_result(df, order=["id"])
    assert [r["id"] for r in result.read(0, 5)["rows"]] == [0]
    middle = result.read(1, 5)
    assert middle["rows"] == [{"_oversized_row": 1, "full_result": result.path}]
    assert (middle["next_offset"], middle["truncated"]) == (2, True)
    assert result.read(2, 5)["next_offset"] is None


def test_repeated_names(spark):
    assert unique_names(spark.sql("SELECT 1 AS a, 2 AS a, 3 AS a_1, 4 AS a")).columns == ["a", "a_1", "a_1_2", "a_3"]
    assert store_result(spark.sql("SELECT 1 AS a, 2 AS a")).page().columns == ["a", "a_1", "_row"]


def test_small_views(spark, facts):
    assert preview(facts)["row_count"] is None and len(preview(facts)["preview"]) == 2
    with pytest.raises(ValueError):
        rows_for_person(facts, most=1)
    assert len(rows_for_person(facts, most=2)) == 2


SPEC = ingest.PipelineSpec(
    id="scaled", version="1", params=("multiplier",), functions={"twice": (lambda x: None if x is None else x * 2, "double")},
    steps=[("facts", """SELECT item, value * coalesce((SELECT CAST(max(value_json) AS DOUBLE) FROM {run_params} WHERE name = 'multiplier'), 1) AS value,
                          category, evidence_id, asset_id FROM {observed}"""),
           ("doubled", "SELECT item, twice(value) AS value FROM {facts}"),
           ("evidence", lambda spark, tables: tables["observed"].select(
               "evidence_id", "asset_id", F.lit("{}").alias("locator_json"), F.col("item").alias("quote")))],
    outputs={"facts": "facts", "doubled": "doubled", "evidence": "evidence"})


def test_pipeline_versions_and_reuse(spark, facts, tmp_path):
    root = str(tmp_path)
    inputs = {"observed": facts, "input_files": facts.select("asset_id").distinct()}
    first = ingest.run(spark, SPEC, inputs, {}, root, "s")
    again = ingest.run(spark, SPEC, inputs, {}, root, "s")
    scaled = ingest.run(spark, SPEC, inputs, {"multiplier": 2}, root, "s")
    assert (first["reused"], again["reused"], scaled["reused"]) == (False, True, False)
    assert first["artifact_id"] == again["artifact_id"] != scaled["artifact_id"]
    total = {k: r["tables"]["facts"].agg(F.sum("value")).first()[0] for k, r in (("first", first), ("scaled", scaled))}
    assert total == {"first": 30.0, "scaled": 60.0}
    assert scaled["tables"]["doubled"].agg(F.sum("value")).first()[0] == 120.0
    with pytest.raises(ValueError, match="undeclared"):
        ingest.run(spark, SPEC, inputs, {"other": 1}, root, "s")
    with pytest.raises(ContractError, match="asset is not loaded"):
        ingest.run(spark, SPEC, {**inputs, "input_files": inputs["input_files"].filter("false")}, {}, root, "s")
    assert artifacts.index(spark, root).count() == 2


def test_workspace(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "input.csv").write_text("item,value\nA,10\nB,20\n")
    work = Workspace(spark, str(tmp_path / "work"))
    work.load_file(str(tmp_path / "in" / "input.csv"), "input")
    assert work.assets.first()["media_type"] == "text/csv"
    result = work.sql("SELECT sum(value) AS total, sum(value) AS total FROM input WHERE value >= ?", [10], name="totals")
    assert work.read(result)["rows"] == [{"total": 30, "total_1": 30}]
    work.register("increment", lambda n: n + 1, ["BIGINT"], "bigint")
    assert work.read(work.sql("SELECT increment(CAST(41 AS BIGINT)) AS n"))["rows"] == [{"n": 42}]
    with pytest.raises(ValueError):
        work.register("increment", lambda n: n, ["BIGINT"], "bigint")
    assert work.describe_functions() == [{"name": "increment", "parameters": ["BIGINT"], "return_type": "bigint"}]
    assert work.python(lambda spark, tables: {"more": tables["input"].withColumn("value", F.col("value") * 2)}) == ["more"]
    assert rows(work.catalog(), "name", "kind") == [("input", "file"), ("more", "python"), ("totals", "sql")]
    assert work.describe("input")["schema"][1] == {"name": "value", "type": "bigint"}
    with pytest.raises(Exception):
        work.sql("SELECT nothing FROM input")
    assert work.digest("input") == work.digest("input") and work.changed_sources().count() == 0
    saved = work.checkpoint(["input"])
    with pytest.raises(ValueError):
        work.checkpoint(["input", "input"])
    fresh = Workspace(spark, work.root)
    assert fresh.restore(saved) == ["input"] and fresh.tables["input"].count() == 2
    assert fresh.assets.first()["path"].endswith("#" + work.assets.first()["asset_id"])
    assert fresh.changed_sources().count() == 0
    again = Workspace(spark, work.root)
    assert again.restore(fresh.checkpoint(["input"])) == ["input"]
    assert again.pipeline(ingest.PipelineSpec("sum", "1", [("total", "SELECT sum(value) AS total FROM {input}")], {"totals": "total"}),
                          ["input"])["tables"]["totals"].first()["total"] == 30
    (tmp_path / "in" / "input.csv").write_text("item,value\nA,11\nB,20\n")
    assert rows(work.changed_sources(), "status") == [("mismatch",)]
    with pytest.raises(ContractError, match="source changed"):
        work.checkpoint(["input"])
    work.sql("SELECT 'password=hidden' AS p")
    assert not work.operations().filter("request LIKE '%hidden%'").count()
    log = work.operations().filter("request NOT LIKE '%REDACTED%'").orderBy(F.desc("finished_at")).collect()
    assert [r["action"] for r in log][:3] == ["checkpoint", "execute", "restore"]
    assert {r["status"] for r in log} == {"succeeded", "failed"}
    assert json.loads(next(r for r in log if r["action"] == "load")["output_tables"]) == ["input"]


def test_workspace_knowledge_and_pipeline(spark, facts, tmp_path):
    work = Workspace(spark, str(tmp_path / "work"))
    work.add("observed", facts)
    work.add("input_files", facts.select("asset_id").distinct())
    run = work.pipeline(SPEC, ["observed", "input_files"])
    assert f"{run['prefix']}_facts" in work.tables
    page = {"knowledge_id": "k", "page": 1, "success": True, "total": 1,
            "data": [{"id": "c", "chunk_index": 0, "content": f"see ARTIFACT:{run['artifact_id']}"}]}
    (tmp_path / "pages.json").write_text(json.dumps(page))
    (tmp_path / "docs.json").write_text(json.dumps({"success": True, "data": {"id": "k", "knowledge_base_id": "kb", "title": "t"}}))
    made = work.load_knowledge("k", str(tmp_path / "docs.json"), str(tmp_path / "pages.json"), ["kb"])
    assert rows(made["k_artifacts"], "artifact_id", "status") == [(run["artifact_id"], "loaded")]
    assert made["k_completeness"].first()["complete"]
    assert work.load_artifact("again", run["artifact_id"])["again_facts"].count() == 2
    assert work.load_marked("k") == [run["artifact_id"]]
    requested = spark.createDataFrame([("k", "gone")], "knowledge_id string, chunk_id string")
    with pytest.raises(ValueError, match="chunks not found: 1"):
        work.load_knowledge("x", str(tmp_path / "docs.json"), str(tmp_path / "pages.json"), ["kb"], requested)


def test_arrivals_are_taken_once(spark, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def land(batch, number):
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    for name, text in (("a.csv", "item,value\nA,15\nB,25\n"), ("b.csv", "item,value\nA,18\n")):
        (folder / name).write_text(text)
        take_arrivals(spark, str(folder), "item string, value double", str(tmp_path / "progress"), land)
    landed = spark.read.parquet(target)
    assert landed.count() == 3 and landed.select("source_file").distinct().count() == 2


def test_database_options():
    plain = database.query_options("jdbc:x", "SELECT 1", {"user": "u"})
    assert plain == {"url": "jdbc:x", "fetchsize": "10000", "user": "u", "query": "SELECT 1"}
    split = database.query_options("jdbc:x", "SELECT id FROM t", partition_column="id", bounds=(0, 9), partitions=4)
    assert split["dbtable"] == "(SELECT id FROM t) q" and split["numPartitions"] == "4" and "query" not in split
    with pytest.raises(ValueError):
        database.query_options("jdbc:x", "SELECT 1", partition_column="id")

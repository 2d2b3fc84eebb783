import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from factline.operators import publish
from factline.operators.checks import ContractError
from factline.plans import documents, ingest
from factline.plans.documents import Model, ingest_documents
from factline.sources import artifacts
from factline.storage import work_folder

ASSETS = "asset_id string, media_type string, original_name string, content binary"
PNG = bytes.fromhex("89504e470d0a1a0a") + bytes(8)
CSV = ("csv", "text/csv", "input.csv", b"item,value\nA,10\nB,20\n")
PDF = ("pdf", "application/pdf", "new-report.pdf", b"%PDF")
IMAGE = ("png", "image/png", "new-report.png", PNG)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([("pdf", 1, "Operational report\nA,15\nB,25\n")], "asset_id string, page bigint, text string")


def assets(spark, *rows_):
    return spark.createDataFrame(list(rows_), ASSETS)


def test_files_and_paged_text(spark, pages, tmp_path):
    result = ingest_documents(spark, assets(spark, CSV, PDF), str(tmp_path), "s", pages)
    tables = result["tables"]
    assert dict(map(tuple, tables["facts"].groupBy("asset_id").agg(F.sum("value")).collect())) == {"csv": 30.0, "pdf": 40.0}
    assert rows(tables["documents"]) == [("csv", "input.csv", "item,value\nA,10\nB,20\n"), ("pdf", "new-report.pdf", "Operational report\nA,15\nB,25\n")]
    ordered = publish.in_order(tables["evidence"]).select("evidence_id", "locator_json").collect()
    assert [tuple(r) for r in ordered] == [("csv:2", '{"row":2}'), ("csv:3", '{"row":3}'), ("pdf:1", '{"page":1}')]
    assert tables["facts"].join(tables["evidence"], "evidence_id", "left_anti").count() == 0
    again = ingest_documents(spark, assets(spark, CSV, PDF), str(tmp_path), "s", pages)
    scaled = ingest_documents(spark, assets(spark, CSV, PDF), str(tmp_path), "s", pages, multiplier=2)
    assert again["reused"] and again["artifact_id"] == result["artifact_id"] and not scaled["reused"]
    assert scaled["tables"]["facts"].agg(F.sum("value")).first()[0] == 140.0


@pytest.mark.parametrize("refused, message", [
    ((IMAGE,), "a model is required"), ((PDF,), "a model is required"),
    ((("x", "application/zip", "x.zip", b"PK"),), "unsupported media type"), ((("y", "image/png", "y.png", b"no image"),), "not readable")])
def test_unreadable_documents_publish_nothing(spark, tmp_path, refused, message):
    with pytest.raises(ContractError, match=message):
        ingest_documents(spark, assets(spark, CSV, *refused), str(tmp_path), "s")
    assert artifacts.index(spark, str(tmp_path)).count() == 0


def test_model_reads_every_document(spark, pages, tmp_path):
    def reply(request):
        content = json.loads(request)["messages"][0]["content"]
        value = 16 if "revised" in content[0]["text"] else 15
        row = {"item": "A", "value": value, "quote": f"{len(content)} parts", "page": 1, "bbox": [0.1, 0.1, 0.5, 0.5]}
        return "```json\n" + json.dumps({"observations": [row]}) + "\n```"

    model = Model("reader", "Give observations.", reply)
    first = ingest_documents(spark, assets(spark, CSV, PDF, IMAGE), str(tmp_path), "s", pages, model)
    assert rows(first["tables"]["evidence"], "evidence_id", "locator_json", "quote") == [
        ("csv:1", "{}", "1 parts"), ("pdf:1", '{"page":1}', "1 parts"), ("png:1", '{"bbox":[0.1,0.1,0.5,0.5]}', "2 parts")]
    assert first["warnings"] and first["tables"]["facts"].agg(F.sum("value")).first()[0] == 45.0
    revised = ingest_documents(spark, assets(spark, IMAGE), str(tmp_path), "s", None, model, prompt="revised")
    assert revised["tables"]["facts"].first()["value"] == 16.0
    with pytest.raises(ContractError, match="model reply"):
        ingest_documents(spark, assets(spark, IMAGE), str(tmp_path), "s", None, Model("bad", "p", lambda request: "not JSON"))
    scan = spark.createDataFrame([("pdf", n, " ") for n in range(1, 10)], "asset_id string, page bigint, text string")
    assert ingest_documents(spark, assets(spark, PDF), str(tmp_path), "s", scan, model)["tables"]["facts"].count() == 1


def test_page_beyond_the_source_publishes_nothing(spark, pages, tmp_path):
    far = json.dumps({"observations": [{"item": "A", "value": 1, "quote": "q", "page": 99}]})
    with pytest.raises(ContractError, match="page exceeds the source"):
        ingest_documents(spark, assets(spark, PDF), str(tmp_path), "s", pages, Model("m", "p", lambda request: far))
    with pytest.raises(ContractError, match="asset ids"):
        ingest_documents(spark, assets(spark, CSV, CSV), str(tmp_path), "s")
    assert artifacts.index(spark, str(tmp_path)).count() == 0


def test_other_model_settings_are_another_run(spark, pages, tmp_path):
    def reader(value):
        return lambda request: json.dumps({"observations": [{"item": "A", "value": value, "quote": "q"}]})

    def run(model):
        return ingest_documents(spark, assets(spark, PDF), str(tmp_path), "s", pages, model)

    first = run(Model("m", "p", reader(1)))
    assert run(Model("m", "p", reader(1)))["reused"]
    for changed in (Model("m", "other", reader(1)), Model("m", "p", reader(2)), Model("m", "p", reader(1), temperature=1),
                    Model("m", "p", reader(1), max_tokens=9)):
        again = run(changed)
        assert not again["reused"] and again["artifact_id"] != first["artifact_id"]


def test_assets_are_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(media_type):
        read.add(1)
        return media_type

    counting = assets(spark, *[(f"csv{i}", *CSV[1:]) for i in range(5)]).withColumn("media_type", F.udf(counted)("media_type"))
    result = ingest_documents(spark, counting, str(tmp_path), "s")
    assert read.value == 5 and result["tables"]["facts"].count() == 10


def test_the_asset_table_of_a_run_is_stored(spark, tmp_path):
    """Ids that are hashes are joined by their size in files, not by a guess of their length."""
    loaded = spark.range(3).select(F.sha2(F.col("id").cast("string"), 256).alias("asset_id"))

    def step(spark, tables):
        return spark.range(1).select(F.lit(len(tables["input_files"].inputFiles())).alias("files"))

    spec = ingest.PipelineSpec(id="stored", version="1", steps=[("plain", step)], outputs={"plain": "plain"})
    made = ingest.run(spark, spec, {"input_files": loaded}, {}, str(tmp_path), "s")
    assert made["tables"]["plain"].first()["files"] > 0


def test_many_small_assets_are_stored_in_few_files(spark, tmp_path):
    folder = Path(work_folder(spark).removeprefix("file:"))
    before = set(folder.glob("assets-*"))
    many = assets(spark, *[(f"csv{i}", *CSV[1:]) for i in range(300)]).repartition(200)
    assert ingest_documents(spark, many, str(tmp_path), "s")["tables"]["facts"].count() == 600
    stored, = set(folder.glob("assets-*")) - before
    assert len(list(stored.glob("*.parquet"))) <= max(documents.STORE_TASKS, 8 * spark.sparkContext.defaultParallelism)

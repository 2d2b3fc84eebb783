import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from factline.functions.canonical import canonical
from factline.operators import observations as obs
from factline.operators import publish
from factline.sources import files

# An input file and its hash.
INPUT = b"item,value\nA,10\nB,20\n"
INPUT_SHA = "0b20d847c0033e537f5f7ab94319beeef1ce6248929253316acf24142b3b2516"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "input.csv").write_bytes(INPUT)
    (tmp_path / "history.csv").write_text("item,value,category\nA,10,\nB,20,\n")
    (tmp_path / "odd.csv").write_bytes('\ufeffitem,value,category\r\n"x\r\ny",,\n\nz,1_0\n'.encode())
    (tmp_path / "picture.png").write_bytes(bytes.fromhex("89504e470d0a1a0a") + b"\0" * 20)
    (tmp_path / "notes.bin").write_bytes(b"?" * 500)
    return str(tmp_path)


def test_assets(spark, folder):
    assets = files.scan_assets(spark, folder)
    found = {r["original_name"]: r for r in assets.collect()}
    assert set(found) == {"input.csv", "history.csv", "odd.csv", "picture.png", "notes.bin"}
    assert found["picture.png"]["media_type"] == "image/png"
    assert found["input.csv"]["sha256"] == hashlib.sha256(INPUT).hexdigest()
    assert rows(files.oversized_files(spark, folder, max_bytes=400), "length") == [(500,)]
    assert files.total_bytes(spark, folder).first()["files"] == 5
    assert hashlib.sha256(INPUT).hexdigest() == INPUT_SHA


def test_csv_records_to_published_tables(spark, folder):
    assets = files.scan_assets(spark, folder, "input.csv", content=True)
    records = obs.csv_records(obs.csv_documents(assets), batch=1)
    facts = publish.facts_of(records)
    assert facts.agg(F.count("*"), F.sum("value")).first()[:] == (2, 30.0)
    assert sorted(r["locator_json"] for r in publish.evidence_of(records).collect()) == ['{"row":2}', '{"row":3}']
    assert facts.agg(F.sum("value")).first() != obs.scale(facts, 2).agg(F.sum("value")).first()
    assert obs.scale(facts, 2).agg(F.sum("value")).first()[0] == 60.0


def test_csv_corner_cases(spark, folder):
    assets = files.scan_assets(spark, folder, "odd.csv", content=True)
    got = rows(obs.csv_records(obs.csv_documents(assets)), "key", "item", "value", "category", "quote")
    assert got == [("2", "x\ny", None, None, '{"item": "x\\ny", "value": "", "category": ""}'),
                   ("3", "z", 10.0, None, '{"item": "z", "value": "1_0", "category": null}')]


def test_tables_from_files(spark, folder, tmp_path):
    table = files.load_table(spark, f"{folder}/input.csv")
    assert dict(table.dtypes) == {"item": "string", "value": "bigint"}
    history = files.load_table(spark, f"{folder}/history.csv")
    assert rows(history, "category") == [(None,), (None,)]
    table.write.parquet(str(tmp_path / "t.parquet"))
    assert files.load_table(spark, str(tmp_path / "t.parquet")).count() == 2
    with pytest.raises(ValueError):
        files.load_table(spark, f"{folder}/notes.bin")


def test_bad_number_fails(spark):
    assets = spark.createDataFrame([("a", b"item,value\nA,ten\n")], "asset_id string, content binary")
    with pytest.raises(Exception, match="could not convert"):
        obs.csv_records(obs.csv_documents(assets)).collect()


def test_table_records(spark):
    df = spark.createDataFrame([("s", "A", 10, "x"), ("s", "B", None, ""), ("t", "C", 5, None)], "src string, i string, v int, c string")
    plain = obs.table_records(df, "src", "i", "v", "c", ["i"])
    assert rows(plain, "asset_id", "key", "quote", "category")[:2] == [
        ("s", "2", '{"item":"A","value":10.0,"category":"x"}', "x"), ("s", "3", '{"item":"B","value":null,"category":null}', None)]


def test_paged_report(spark):
    pages = spark.createDataFrame([("r", 1, "Operational report\nA,15\nB,25\n"), ("r", 2, "no figures here")], "asset_id string, page int, text string")
    found = obs.page_observations(pages)
    assert found.agg(F.sum("value")).first()[0] == 40.0
    assert rows(publish.evidence_of(obs.page_evidence(pages)), "evidence_id", "locator_json") == [
        ("r:1", '{"page":1}'), ("r:2", '{"page":2}')]
    assert rows(found, "item", "key") == [("A", "1"), ("B", "1")]


def test_joined_pages(spark):
    pages = [("big", n, f"page {n}") for n in range(1, 41)] + [("small", 1, "one"), ("small", 2, "two")]
    df = spark.createDataFrame(pages, "asset_id string, page int, text string")
    whole = {r["asset_id"]: r["markdown"] for r in obs.join_pages(df).collect()}
    assert whole == {"big": "\n\n".join(f"page {n}" for n in range(1, 41)), "small": "one\n\ntwo"}


def test_routes(spark):
    head = bytes.fromhex("89504e470d0a1a0a")
    data = [("a", "text/csv", b""), ("b", "application/pdf", b""), ("c", "image/png", head + b"\0" * 9), ("d", "image/png", b"plain"),
            ("e", "image/webp", b"RIFF\0\0\0\0WEBP"), ("f", "application/octet-stream", b"")]
    got = rows(obs.route_assets(spark.createDataFrame(data, "asset_id string, media_type string, content binary")), "asset_id", "route", "reason")
    assert got == [("a", "records", None), ("b", "pages", None), ("c", "image", None), ("d", "rejected", "image bytes are not readable"),
                   ("e", "image", None), ("f", "rejected", "unsupported media type")]


def test_documents_that_need_a_model(spark):
    data = [("a", "image/png", "x", 1), ("b", "application/pdf", " \n", 3), ("c", "application/pdf", "", 9), ("d", "application/pdf", "t", 9)]
    documents = spark.createDataFrame(data, "asset_id string, media_type string, markdown string, pages int")
    assert obs.need_model(documents).filter("model_problem IS NOT NULL").count() == 0
    got = obs.need_model(documents, scanned_pages=8)
    assert [(r["model_required"], r["model_problem"] is not None) for r in got.orderBy("asset_id").collect()] == [
        (True, False), (True, False), (True, True), (False, False)]


def test_image_request_carries_the_image(spark):
    import json

    df = spark.createDataFrame([("a", "image/png", "m", b"ab")], "asset_id string, media_type string, markdown string, content binary")
    body = json.loads(obs.model_requests(df, "base", "reader", "task").first()["request"])
    assert body["messages"][0]["content"] == [{"type": "text", "text": "base\ntask\nDocument:\nm"},
                                              {"type": "image_url", "image_url": {"url": "data:image/png;base64,YWI="}}]
    assert (body["temperature"], body["max_tokens"], body["stream"]) == (0, 2048, False)


def test_replies(spark):
    good = {"observations": [{"item": "A", "value": 15, "category": None, "quote": "A 15", "page": 1, "bbox": [0.1, 0.1, 0.5, 0.5]}]}
    text = canonical(good)
    data = [("image", "image/png", text), ("paged", "application/pdf", f"```json\n{text}\n```"), ("plain", "text/csv", text),
            ("flag", "application/pdf", text.replace('"page":1', '"page":true')), ("box", "image/png", text.replace("0.1,0.1", "0.9,0.1")),
            ("long", "image/png", text.replace("[0.1,", "[0,0.1,")), ("words", "image/png", text.replace(":15", ':"15"')),
            ("bad", "image/png", "not JSON"), ("none", "image/png", '{"observations":3}'), ("part", "image/png", text.replace("quote", "said")),
            ("nan", "image/png", text.replace(":15", ':"fifteen"')), ("null", "image/png", text.replace(":15", ":null").replace('"A 15"', "null"))]
    records, rejected = obs.sanitize_replies(spark.createDataFrame(data, "asset_id string, media_type string, reply string"))
    got = {r["asset_id"]: (r["locator_json"], r["value"], r["quote"], r["key"]) for r in records.collect()}
    assert got == {
        "image": ('{"bbox":[0.1,0.1,0.5,0.5]}', 15.0, "A 15", "1"), "paged": ('{"page":1}', 15.0, "A 15", "1"), "plain": ("{}", 15.0, "A 15", "1"),
        "flag": ("{}", 15.0, "A 15", "1"), "box": ("{}", 15.0, "A 15", "1"), "long": ("{}", 15.0, "A 15", "1"),
        "words": ('{"bbox":[0.1,0.1,0.5,0.5]}', 15.0, "A 15", "1"), "null": ('{"bbox":[0.1,0.1,0.5,0.5]}', None, "None", "1")}
    assert {r["asset_id"] for r in rejected.collect()} == {"bad", "none", "part", "nan"}


def test_model_calls(spark):
    requests = spark.createDataFrame([(n, f"ask {n}") for n in range(10)], "n int, request string")
    assert rows(obs.call_model(requests, str.upper, partitions=3), "reply") == sorted((f"ASK {n}",) for n in range(10))


def test_params(spark):
    schema = "name string, value_json string"
    one = publish.fold_params(spark.createDataFrame([("b", "2"), ("a", '"x"')], schema)).first()[0]
    assert one == '{"a":"\\"x\\"","b":"2"}'
    assert publish.fold_params(spark.createDataFrame([], schema)).first()[0] == "{}"
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        publish.fold_params(spark.createDataFrame([("a", "1"), ("a", "2")], schema)).collect()


def test_null_key_gives_null_evidence_id(spark):
    got = spark.sql("SELECT 'a' AS a, CAST(NULL AS STRING) AS k").select(publish.evidence_id(F.col("a"), F.col("k")))
    assert got.first()[0] is None

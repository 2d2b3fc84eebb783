"""CSV records of many blocks against Python's own reader."""

import csv
import io
import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from factline.operators import delimited, observations
from factline.sources import files

COLUMNS = ["asset_id", "key", "locator_json", "quote", "item", "value", "category"]


def expected(asset, body):
    reader = csv.DictReader(io.StringIO(body))
    for number, row in enumerate(reader, 2):
        value = row.get("value")
        yield (asset, str(number), f'{{"row":{number}}}', json.dumps(row, ensure_ascii=False), row.get("item"),
               float(value) if value not in (None, "") else None, row.get("category") or None)


PIECES = ['a', 'b"c', '"', '""', ',', '\n', '"x\ny"', '"q""r"', '"s,t"', '"u"v', ' "w"', '1', 'é', '\\', '\t', '', '\n\n', '"\n', '\x0b', '\x1f']


def wild(rng, n):
    """Text of quotes, commas and line ends in any order, with numbers where a value may stand."""
    body = "item,note,category\n" + "".join(rng.choice(PIECES) for _ in range(n))
    return body


def test_any_text_is_read_as_python_reads_it(spark):
    rng = random.Random(7)
    texts = {f"t{i}": wild(rng, rng.randint(0, 60)) for i in range(300)}
    texts |= {"none": "", "head": "item,value", "dup": "item,item,value\n1,2,3\n4\n5,6,7,8,\"9\"\n", "numbers": "value\n1\n-2.5e3\n\" 1_0 \"\nnan\n.5\n\"\"\n٣\n"}
    documents = spark.createDataFrame(list(texts.items()), "asset_id string, markdown string")
    want = sorted((repr(r) for a, t in texts.items() for r in expected(a, t)))
    for block_lines in (3, 1, 100):
        got = delimited.csv_records(delimited.lines_of_text(documents, block_lines))
        assert got.columns == COLUMNS
        assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_one_file_gives_many_tasks(spark, tmp_path):
    rng = random.Random(8)
    texts = {f"f {i}+é%20.csv": "﻿" * (i % 2) + "item,value,category\n" + "".join(
        f'"part {n}{rng.choice(["", chr(10), ", ", chr(34) * 2])}",{n},{rng.choice(["", "x", chr(34) + "y" + chr(10) + chr(10) + "z" + chr(34)])}\n'
        for n in range(rng.randint(0, 60))) for i in range(6)}
    for name, body in texts.items():
        (tmp_path / name).write_bytes(body.replace("\n", "\r\n" if " 3" in name else "\n").encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
        lines = files.csv_lines(spark, str(tmp_path), "*.csv")
        blocks = {r["asset_id"]: r["n"] for r in lines.groupBy("asset_id").agg(F.count_distinct("block").alias("n")).collect()}
        assert max(blocks.values()) > 5
        assets = files.scan_assets(spark, str(tmp_path), "*.csv")
        got = rows(delimited.csv_records(lines, assets))
        names = {r["asset_id"]: r["original_name"] for r in assets.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((names[r[0]], *r[1:]) for r in got) == sorted(r for name, body in texts.items() for r in expected(name, body.lstrip("﻿")))


def test_a_task_holds_few_lines_of_a_file_at_a_time(spark, tmp_path):
    body = "item,value\n" + "".join(f'"part\n""{n}""",{n}\n\n' for n in range(400))
    (tmp_path / "long.csv").write_text(body)
    lines = files.csv_lines(spark, str(tmp_path), "*.csv", block_lines=9)
    held = lines.groupBy("block").count()
    assert held.agg(F.max("count")).first()[0] <= 9 and held.agg(F.sum("count")).first()[0] == 1201
    named = spark.createDataFrame([("long",)], "asset_id string").crossJoin(lines.select("asset_id").distinct().withColumnRenamed("asset_id", "path"))
    got = delimited.csv_records(lines, named)
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(repr(r) for r in expected("long", body))


def test_states_of_lines(spark):
    def state(line, inside):
        reader = csv.reader(iter([('"' if inside else "") + line, "end"]))
        return len(next(reader)) and "end" in "".join(next(csv.reader(iter([('"' if inside else "") + line + "\n", "end"]))))

    rng = random.Random(9)
    lines = ["".join(rng.choice('ab",') for _ in range(rng.randint(0, 9))) for _ in range(600)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = {r[0]: (r[1], r[2]) for r in df.select("i", F.col("line").rlike(delimited.OPENS), F.col("line").rlike(delimited.STAYS)).collect()}
    for i, line in enumerate(lines):
        assert got[i] == (bool(state(line, False)), bool(state(line, True))), line


def test_long_fields_need_no_stack(spark):
    field = '"' + 'x""y' * 60_000 + '"'
    documents = spark.createDataFrame([("a", f"item,value\n{field},1\n{field}\n")], "asset_id string, markdown string")
    got = delimited.csv_records(delimited.lines_of_text(documents)).orderBy("key").collect()
    assert [len(r["item"]) for r in got] == [180_000, 180_000] and got[0]["value"] == 1.0


@pytest.mark.parametrize("bad", ["ten", "1__0", "1_", "0x1", "1.0d", "1 0"])
def test_what_python_refuses_fails(spark, bad):
    documents = spark.createDataFrame([("a", f"item,value\nA,{bad}\n")], "asset_id string, markdown string")
    with pytest.raises(Exception, match="could not convert"):
        delimited.csv_records(delimited.lines_of_text(documents)).collect()


def test_short_texts_without_quotes_are_read_where_they_lie(spark):
    rng = random.Random(10)
    pieces = [p for p in PIECES if '"' not in p] + ["$1", "\\$", "a,b,c\n", "x,2,y\n"]
    heads = ["item,note,category\n", "\n\nitem,category\n", "item,item,category\n", "no$te,item,x\\y\n", "category\n", ",item\n", "\ufeffitem,note\n", ""]
    texts = {f"t{i}": heads[i % len(heads)] + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for i in range(400)}
    texts |= {"numbers": "value\n1\n-0\n-2.5e3\n 1_0 \nnan\n.5\n٣\n00012.50\n123456789012345678901\n", "quoted": 'item,value\n"a\nb",1\nc,2\n'}
    documents = spark.createDataFrame([*texts.items(), (None, "item\na\n"), ("no text", None)], "asset_id string, markdown string")
    plain = documents.filter(delimited.is_plain(F.col("markdown")))
    assert plain.count() == len(texts)
    assert "Exchange" not in delimited.plain_records(plain)._jdf.queryExecution().toString()
    got = observations.csv_records(documents)
    assert got.columns == COLUMNS
    # Blank lines before the names are passed over here, not by Python.
    want = [r for a, t in texts.items() for r in expected(a, t.removeprefix("\ufeff").lstrip("\n"))]
    found = sorted(repr(tuple(r)) for r in got.collect())
    assert found == sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in delimited.csv_records(delimited.lines_of_text(documents)).collect())


def test_long_texts_go_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(delimited, "PLAIN_BYTES", 30)
    texts = {"short": "item,value\na,1\n", "long": "item,value\n" + "b,2\n" * 40}
    documents = spark.createDataFrame(list(texts.items()), "asset_id string, markdown string")
    assert [r["asset_id"] for r in documents.filter(delimited.is_plain(F.col("markdown"))).collect()] == ["short"]
    got = observations.csv_records(documents, batch=7).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr(r) for a, t in texts.items() for r in expected(a, t))

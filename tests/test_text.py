import base64
import mimetypes
import re

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factline.functions import text
from factline.functions.canonical import canonical, canonical_row, digest

# The patterns that the library's own must agree with.
GRAMMAR = re.compile(r"\s*([\w -]+)\s*[,：:]\s*(-?\d+(?:\.\d+)?)\s*(?:,\s*(.*))?")
FENCE = re.compile(r"^```(?:json)?\s*|\s*```$")
SECRET = re.compile(r"(?i)(password|api_key|token)\s*=\s*[^\s;&]+")


def observed(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "n int, line string").withColumn("cut", text.cut_observation(F.col("line")))
    item, value, category = text.observation_parts(F.col("cut"))
    matched = df.filter(F.col("cut") != F.col("line")).select("n", item, value, category)
    return {r[0]: tuple(r[1:]) for r in matched.collect()}


def expected(lines):
    found = {n: GRAMMAR.fullmatch(line) for n, line in enumerate(lines)}
    return {n: (m[1].strip(), float(m[2]), m[3] or None) for n, m in found.items() if m}


def test_grammar_cases(spark):
    lines = [
        "A,15", "B,25", "Operational report", "A,18,retail", "  item one : -3.50 ,  two words ", "水,７５", "x：٣.٥,y", ",5",
        " ,5", "   ,5", "\t,5", "a b,5", "a_b-c,1", "a,1.", "a,.5", "a,1e5", "a,1,", "a, 1 , ,b", "é,2 ,　z", "a,b,5",
        "a\x1f,5", "x́,5", "- - ,9,,", "a,5;b", "a\x005\x00", "a,5,b\x00c",
    ]
    assert observed(spark, lines) == expected(lines)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aé水 _-,：:.\t 　 0５9x\x1f́", max_size=14), min_size=30, max_size=200))
def test_grammar_agrees_with_python(spark, lines):
    assert observed(spark, lines) == expected(lines)


def test_grammar_is_linear(spark):
    long = [" " * 200_000 + "x", "a " * 100_000 + ";", " " * 100_000 + "#,5", "a" * 200_000]
    assert observed(spark, long) == {}


def test_lines_agree_with_python(spark):
    body = "a\r\nb\x0bc\x0cd\re\x1cf\x1dg\x1eh\x85i j k\nl\x1fm"
    got = spark.createDataFrame([(body,)], "t string").select(text.lines(F.col("t"))).first()[0]
    assert got == body.splitlines()


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="` \njson{}ab ", max_size=20), min_size=20, max_size=100))
def test_fence_agrees_with_python(spark, replies):
    df = spark.createDataFrame(list(enumerate(replies)), "n int, t string").select("n", text.strip_fence(F.col("t")))
    assert dict(map(tuple, df.collect())) == {n: FENCE.sub("", t.strip()) for n, t in enumerate(replies)}


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["password", "API_KEY", "myToken", " ", "=", "x", ";", "&", " ", "\n", "toKen"]),
                         max_size=9).map("".join), min_size=20, max_size=100))
def test_redaction_agrees_with_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", text.redact(F.col("t"), ["xx=xx"]))
    want = {n: SECRET.sub(r"\1=[REDACTED]", t.replace("xx=xx", "[REDACTED]")) for n, t in enumerate(texts)}
    assert dict(map(tuple, df.collect())) == want


def test_known_secrets():
    variables = {"DB_DSN": "postgres://x", "api_key": "12345", "MY_TOKEN": "1234", "HOME": "/root/home"}
    assert text.known_secrets(variables) == ["postgres://x", "12345"]


def test_media_types(spark):
    names = ["a.csv", "A.CSV", "b.PDF", "c.png", "d.jpeg", "e.JPG", "f.webp", "g", ".csv", "h.csv.gz", "i.tar.gz", "j.tgz",
             "k.html", "dir.csv/l", "m.json", "n.unknownsuffix", "o.md", "..png", "p.txt"]
    df = spark.createDataFrame([(n,) for n in names], "p string").select("p", text.media_type(F.col("p")))
    mimetypes.add_type("text/markdown", ".md")
    got = {p: m for p, m in df.collect()}
    assert got == {n: mimetypes.guess_type(n.rsplit("/", 1)[-1])[0] or text.OTHER_MEDIA for n in names}
    assert spark.range(1).select(text.media_type(F.lit("x/y.parquet"))).first()[0] == "application/vnd.apache.parquet"


def test_small_text_rules(spark):
    df = spark.createDataFrame([("/d/new-report.v2.csv", b"\xef\xbb\xbfa,1", "", "1.5")], "p string, c binary, e string, v string")
    got = df.select(text.file_name(F.col("p")), text.file_stem(F.col("p")), text.utf8_text(F.col("c")), text.number_or_null(F.col("e")),
                    text.number_or_null(F.col("v")), text.data_url(F.col("c"), F.lit("image/png"))).first()
    assert tuple(got) == ("new-report.v2.csv", "new-report.v2", "a,1", None, 1.5,
                          "data:image/png;base64," + base64.b64encode(b"\xef\xbb\xbfa,1").decode())


def test_markers(spark):
    uid = "12345678-1234-1234-1234-123456789012"
    body = f"NOTE:{uid} note:{uid.replace('1', 'A')}, xNOTE:{uid} NOTE:{uid}9 _NOTE:{uid} (NOTE:{uid})"
    got = spark.createDataFrame([(body,)], "t string").select(text.marker_ids(F.col("t"), "NOTE")).first()[0]
    assert got == [uid, uid.replace("1", "A"), uid]


def test_canonical_json(spark):
    row = [("é\"\u0001/", None, float("nan"), bytearray(b"\x01\xff"), [1, None], {"b": 1, "a": 2}, (2, "x"), 1.5, True)]
    df = spark.createDataFrame(row, "z string, n int, f double, b binary, a array<int>, m map<string,int>, s struct<q:int,p:string>, d double, t boolean")
    want = {"z": "é\"\u0001/", "n": None, "f": "nan", "b": {"encoding": "hex", "value": "01ff"}, "a": [1, None], "m": {"a": 2, "b": 1},
            "s": {"p": "x", "q": 2}, "d": 1.5, "t": True}
    assert df.select(canonical_row(df.schema)).first()[0] == canonical(want)
    assert digest({"b": 1, "a": [None, "é"]}) == digest({"a": [None, "é"], "b": 1})


def test_other_types_become_text(spark):
    df = spark.sql("SELECT CAST(1.50 AS DECIMAL(5,2)) AS d, DATE '2024-01-02' AS day, TIMESTAMP_NTZ '2024-01-02 03:04:05' AS ts")
    assert rows(df.select(canonical_row(df.schema))) == [('{"d":"1.50","day":"2024-01-02","ts":"2024-01-02 03:04:05"}',)]

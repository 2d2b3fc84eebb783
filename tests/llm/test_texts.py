import random
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from brute import documents, saved  # noqa: E402, F401

from factline.llm import bpe, ctw, fuzzy, html, mixing, quality, queries  # noqa: E402

Q = queries.QUERIES
PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER, CODEC = Tokenizer.from_file(PATH), bpe.Codec(PATH)

PAGES = {
    "plain article": ("<nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>Title</h1><p>One  two&amp;<b>three</b></p><p>Be.</p></article>"
                      "<footer>&copy; site</footer>", "Title\nOne two&three\nBe."),
    "no article element": ("<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><div class=menu><a href=1>Home</a> <a href=2>News</a></div>"
                           "<div id='content'><h1>A heading of the page</h1><p>" + "Long text of the page. " * 8 + "</p><p>Short.</p></div>"
                           "<div class=\"comments\"><p>" + "A reader wrote a lot about this. " * 9 + "</p></div></body></html>",
                           "A heading of the page\n" + ("Long text of the page. " * 8).strip() + "\nShort."),
    "advert and form inside": ("<main><p>First part.</p><div class='ad-box'><p>Buy now, only today!</p></div><form><input><label>Mail</label></form>"
                               "<aside>See also</aside><p>Second part.</p></main>", "First part.\nSecond part."),
    "article header kept": ("<header>Site name</header><article><header><h1>Title</h1></header><p>Text &#233; &lt;x&gt;</p></article>", "Title\nText é <x>"),
    "cookie notice": ("<div id=cookie-notice>We use cookies for everything you do here.</div><article><p>Text.</p></article>", "Text."),
    "unclosed": ("<article><p><b>One<br><p>Two<p>Three", "One\nTwo\nThree"),
    "comment and style": ("<!-- <p>no</p> --><style>p{}</style><article><p>Yes<!-- no --> and</p></article>", "Yes and"),
    "no markup": ("only words", "only words"), "empty": ("", ""), "broken": ("<<p <a b='>", None),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, text = PAGES[name]
    assert text is None or html.main_text(page) == text


@pytest.mark.parametrize("wrapper", ['class="content-sidebar-wrap"', 'class="site no-sidebar"', 'id="page-with-nav"'])
@pytest.mark.parametrize("element", ["article", "main", "div"])
def test_wrappers_named_like_furniture(wrapper, element):
    body = "".join(f"<p>Paragraph {i} of the story, long enough to count as text of its own.</p>" for i in range(6))
    said = "<p>A reader wrote a lot about this story.</p>" * 3
    page = (f"<body><div class=menu><a href=1>Home</a></div><div {wrapper}><{element}><h1>Title</h1>{body}</{element}>"
            f"<aside><p>Aside words</p></aside><div class=comments><article class=comment>{said}</article></div></div>"
            "<div class=related><article><p>Teaser</p></article></div></body>")
    found = html.main_text(page)
    assert found.startswith("Title\nParagraph 0") and found.count("Paragraph") == 6
    assert "reader" not in found and "Teaser" not in found and "Home" not in found and "Aside" not in found
    assert html.main_text(f'<div {wrapper} hidden>{body}</div><p>Shown text.</p>') == "Shown text."


PROSE = "<p>The samples that were kept in the cold agree with what the earlier study had found for this species.</p>" * 2


@pytest.mark.parametrize("name", ['id="discussion"', 'class="side-by-side"', 'class="columns side-by-side"', "id=foot", "class=social"])
def test_sections_of_articles_that_read_as_prose(name):
    page = f"<article><h1>Title</h1><p>First.</p><section {name}><h2>Heading</h2>{PROSE}</section><p>Last.</p></article>"
    assert html.main_text(page).count("earlier study") == 2 and "Heading" in html.main_text(page)


@pytest.mark.parametrize("inner", [
    f'<div class="comments discussion">{PROSE}</div>', f"<div class=ad>{PROSE}</div>", f"<aside id=discussion>{PROSE}</aside>",
    f'<div id="discussion" hidden>{PROSE}</div>', '<div class="share"><p>Share</p><p>Print</p></div>',
    f'<div class="related"><p><a href=1>{PROSE[3:-4]}</a></p></div>', '<div class="social"><span>' + "Follow us wherever you are, " * 9 + "</span></div>"])
def test_furniture_inside_articles(inner):
    assert html.main_text(f"<article><h1>Title</h1><p>First.</p>{inner}<p>Last.</p></article>") == "Title\nFirst.\nLast."


def test_formulas_are_text():
    page = "<article><p>So <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>x=1/2</annotation></math> holds.</p></article>"
    assert html.main_text(page) == "So x=12 holds."


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class=ad>", "</div>", "<nav>", "</nav>", "<article>", "</article>", "<b", "x y", "&amp;", "<!--", "-->", ">", "'", "<br>"]), max_size=30))
def test_any_markup_gives_lines(parts):
    found = html.main_text("".join(parts))
    assert found == "\n".join(" ".join(line.split()) for line in found.split("\n") if line)


def test_pages_query(spark, saved):
    rows = [(1, "u", PAGES["plain article"][0]), (2, "v", None), (2, "v", None), (3, None, "")]
    got = Q["op1_html_main_text"](spark, saved(pages=spark.createDataFrame(rows, "page_id long, url string, html string")))
    assert sorted(map(tuple, got.select("page_id", "text", "n_chars").collect())) == [
        (1, "Title\nOne two&three\nBe.", 23), (2, "", 0), (2, "", 0), (3, "", 0)]


def test_fingerprints(spark, documents, saved):
    rows = brute.corpus(9) + [(5000, "é" * 7), (4999, "long " * 3000)]
    got = {r["doc_id"]: r for r in Q["op2_fuzzy_fingerprints"](spark, saved(documents=documents(*rows))).collect()}
    make = lambda t: fuzzy.fingerprints(*fuzzy.flat(fuzzy.pa.array([t.encode()], fuzzy.pa.binary())))[0]
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for i, (doc, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        row = got[doc]
        assert (row["n_chars"], row["fingerprint"], row["edited_fingerprint"]) == (len(text), make(text), make(edited))
        assert row["edited_sha256"] == fuzzy.hashlib.sha256(edited.encode()).hexdigest()
        assert row["near_edited"] == fuzzy.likeness(make(text), make(edited)) and row["near_next"] == fuzzy.likeness(make(text), make(following))


def test_fingerprints_of_odd_tables(spark, documents):
    assert fuzzy.against_edits(documents()).count() == 0
    assert fuzzy.against_edits(documents((7, "alone"))).first()["near_next"] == 1.0
    twice = fuzzy.against_edits(documents((None, None), (1, "same text"), (1, "same text"), (1, "other"), (0, "")))
    assert twice.count() == 5
    assert fuzzy.likeness("0::", "0::") == 1 and fuzzy.likeness("0::", "0:AA:") == 0
    column = documents((1, "abc"), (2, None)).select(fuzzy.fingerprint(F.col("text")).alias("f")).collect()
    assert column[1]["f"] == "0::" and column[0]["f"] != "0::"


def test_common_letters():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in "xy")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert fuzzy._common(a, b) == table[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60) | st.text("ab 'stl1\n\t", max_size=80))
def test_ids_are_exact(text):
    ids = CODEC.encode(text)
    want = TOKENIZER.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want and CODEC.decode(ids) == TOKENIZER.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "x" * 5000, "zqx" * 999, " " * 70, "\x85 　½²é"])
def test_ids_of_odd_texts(text):
    assert CODEC.encode(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_encoding_of_tables(spark, documents):
    docs = documents((1, "Hello there"), (2, None), (2, None), (3, "")).withColumn("ids", F.lit("mine"))
    got = bpe.decode(bpe.encode(docs, PATH), PATH).select("doc_id", "source", "ids", "decoded").collect()
    assert sorted((r["doc_id"], r["decoded"]) for r in got) == [(1, "Hello there"), (2, ""), (2, ""), (3, "")]
    assert [list(r["ids"]) for r in got if r["doc_id"] == 1] == [TOKENIZER.encode("Hello there").ids]
    assert bpe.encode(documents(), PATH).count() == 0 and bpe.round_trip(documents(), PATH).count() == 0


def test_context_trees_agree_with_brute_force(spark, documents, saved):
    rows = brute.corpus(11, 12)
    got = {r["doc_id"]: r for r in Q["op6_context_tree_scores"](spark, saved(documents=documents(*rows))).collect()}
    for doc, (tokens, known, total, base, score) in brute.context_trees(rows).items():
        row = got[doc]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (tokens, known, total)
        assert row["base_score"] == pytest.approx(base) and row["score"] == pytest.approx(score)
    assert {d for d, r in got.items() if r["held_out"]} == {d for d, _ in rows if brute.zlib.crc32(str(d).encode()) % 10 == 0}


def test_scores_of_odd_tables(spark, documents):
    held = F.col("doc_id") < 0
    assert ctw.scores(documents(), held).count() == 0
    rows = ctw.scores(documents((None, None), (1, ""), (1, "")), held).collect()
    assert len(rows) == 3 and all(r["n_tokens"] == 1 and r["train_tokens"] == 3 for r in rows)
    assert ctw.scores(documents((-1, "a b")), held).first()["score"] == pytest.approx(4 * 8 * ctw.np.log10(0.5))


def judged_by_hand(text):
    words = (text or "").encode().split()
    windows = pd.Series([tuple(words[i:i + 3]) for i in range(len(words) - 2)], dtype=object)
    counts = windows.value_counts()
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_quality_rules(spark, documents, saved):
    rng = random.Random(3)
    good = [(i, brute.prose(rng, rng.randint(60, 200), 9)) for i in range(60)]
    junk = [(100 + i, " ".join(w + "%%%" for w in brute.prose(rng, 90, 9).split())) for i in range(40)]
    odd = [(300 + d, t) for d, t in brute.corpus(3, 8)] + [(900, "a | b\nx\nx\n\n\n" * 9), (901, None), (901, None)]
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in good + junk if i % 2] + [(None, 1, 0), (1, None, 0), (1, 1, 1)], "doc_id long, quality int, toxic int")
    folder = saved(documents=documents(*good, *junk, *odd), labels=labels)
    rows = Q["op8_quality_rules"](spark, folder).collect()
    assert len(rows) == len(good) + len(junk) + len(odd)
    texts = dict(good + junk + odd)
    for r in rows:
        assert tuple(r[c] for c in (*quality.METRICS, "base_failed")) == judged_by_hand(texts[r["doc_id"]])
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert kept >= {i for i, _ in good} and not kept & {i for i, _ in junk}


def test_quality_of_odd_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.judge(documents(), labels).count() == 0
    text = brute.prose(random.Random(1), 80)
    docs = documents((1, text), (1, text), (None, None)).withColumn("kept", F.lit("mine"))
    got = quality.judge(docs, labels)
    assert sorted((r["doc_id"] or 0, r["kept"]) for r in got.collect()) == [(0, False), (1, True), (1, True)]


def targets_by_hand(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / share for s in names}
        over = {s for s in names if target[s] > 3 * sizes[s]} - full
        if not over:
            return target
        full |= over


def test_mix(spark, documents, saved):
    rng = random.Random(5)
    sources = ["a", "Zed", "é", None, "b", "c", ""]
    rows = [(i, brute.prose(rng, rng.choice([0, 1, 5, 30, 200])), rng.choice(sources[:4] * 6 + sources)) for i in range(400)]
    folder = saved(documents=documents(*rows))
    found = Q["op9_source_mix"](spark, folder).collect()
    again = Q["op9_source_mix"](spark, folder).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again)) and len(found) == len(rows)
    source = {r[0]: r[2] for r in rows}
    sizes, taken = {}, {}
    for r in found:
        s = source[r["doc_id"]]
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and r["taken"] <= 3 * r["size"]
        sizes[s], taken[s] = sizes.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"]
    want = targets_by_hand(sizes)
    for r in found:
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]]) and r["source_size"] == sizes[source[r["doc_id"]]]
    assert all(abs(taken[s] - want[s]) <= 3 for s in want)


def test_mix_of_odd_tables(spark):
    schema = "doc_id long, source string, size long, target string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    rows = mixing.mix(spark.createDataFrame([(1, None, None, "x"), (1, None, 0, "x"), (None, "s", 4, "x"), (None, "s", 4, "x")], schema)).collect()
    assert sorted((r["size"] or 0, r["target"]) for r in rows) == [(0, 0.0), (0, 0.0), (4, 8.0), (4, 8.0)]
    nothing = mixing.mix(spark.createDataFrame([(1, "s", 0, "x")], schema)).first()
    assert nothing["target"] == 0


def test_small_counts_take_no_logarithm(monkeypatch):
    zeros, ones = np.array([0.0, 1, 4095, 4096, 7e6, 3]), np.array([0.0, 5, 1, 4095, 2, 4e6])
    plain = ctw.log_gamma(zeros + 0.5) + ctw.log_gamma(ones + 0.5) - np.log(np.pi) - ctw.log_gamma(zeros + ones + 1.0)
    assert np.array_equal(ctw.log_estimate(zeros, ones), plain)
    asked = []
    monkeypatch.setattr(ctw, "log_gamma", lambda x: asked.extend(x) or x)
    ctw.log_estimate(zeros[:2], ones[:2])
    assert not asked

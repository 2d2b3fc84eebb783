"""Columns of the caller that are named like an operator's own ones stay as they were."""

import re
import sys
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from factline.llm import bpe, line_dedup, mixing, names, quality, simhash  # noqa: E402

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
GIVEN = {"doc_id", "source", "text", "n_chars"}


def own_names(*modules):
    """Every name in quotes in the modules."""
    found = {name for module in modules for name in re.findall(r'"(\w+)"', Path(module.__file__).read_text())}
    return sorted({x.lower(): x for x in found if not x.isdigit()}.values())


def crowded(spark, taken, made=()):
    """Documents with a number under every such name, and others that need quotes."""
    text = lambda i: f"{brute.prose(brute.random.Random(i % 9), 70)}\n{'a line that many of the documents share, long enough'}"
    docs = spark.createDataFrame([(i, "ab"[i % 2], text(i), 1) for i in range(24)], "doc_id long, source string, text string, n_chars long")
    extra = {x.lower(): x for x in [*taken, "a.b", "row", "_ROW", "two words"]}
    extra = [x for lowered, x in extra.items() if lowered not in GIVEN | set(made)]
    return docs.select("*", *[F.lit(i).alias(name) for i, name in enumerate(extra)])


def unchanged(docs, result, but=()):
    """The columns of the documents are there, with each row's own numbers."""
    shared = [names.quoted(c) for c in docs.columns if c not in {"text", "n_chars", *but}]
    assert [c for c in docs.columns if c not in but] == [c for c in result.columns if c in docs.columns and c not in but]
    assert {tuple(r) for r in result.select(*shared).collect()} <= {tuple(r) for r in docs.select(*shared).collect()}


def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(24)], "doc_id long, quality int")


CASES = {
    "quality": (lambda s, d: quality.judge(d, labels(s)), quality, [*quality.METRICS, "base_failed", "score", "kept"], ()),
    "lines": (lambda s, d: line_dedup.dedup_lines(d, batches=2), line_dedup, ["n_lines", "n_dropped"], ("text",)),
    "mix": (lambda s, d: mixing.mix(d, "n_chars"), mixing, ["source_size", "target", "rate", "copies"], ()),
    "encode": (lambda s, d: bpe.encode(d, TOKENIZER), bpe, ["ids"], ()),
    "decode": (lambda s, d: bpe.decode(bpe.encode(d, TOKENIZER), TOKENIZER), bpe, ["ids", "decoded"], ()),
    "groups": (lambda s, d: simhash.groups(d), simhash, ["fp", "component_id"], ("text",)),
    "first": (lambda s, d: simhash.first_of_groups(d), simhash, [], ()),
}


@pytest.mark.parametrize("case", CASES)
def test_operators_keep_columns_whatever_their_names(spark, case):
    run, module, made, gone = CASES[case]
    docs = crowded(spark, own_names(module), made)
    result = run(spark, docs)
    unchanged(docs, result, gone)
    assert result.columns[-len(made) or len(result.columns):] == made
    assert result.count() == (9 if case == "first" else 24)


@pytest.mark.parametrize("case", [c for c in CASES if CASES[c][2]])
def test_added_columns_replace_those_of_their_names(spark, case):
    run, _, made, _ = CASES[case]
    docs = crowded(spark, [])
    plain = run(spark, docs)
    again = run(spark, docs.withColumns({name.title() if name != "ids" else name: F.lit("old") for name in made}))
    assert again.columns == plain.columns
    assert sorted(map(repr, again.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_return_the_columns_of_their_documents(spark, tmp_path, stage):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    docs = crowded(spark, own_names(corpus_pipeline, quality, line_dedup, simhash, mixing))
    result = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
    assert result.columns == docs.columns
    unchanged(docs, result)
    assert result.count() > 0

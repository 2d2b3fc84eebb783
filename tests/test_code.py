"""Identity of code: what changes an answer changes the identity, and nothing else does."""

import subprocess
import sys
import types

import pytest

from factline.operators import code, observations
from factline.plans import documents, ingest

HELPER = "RATE = 1\n\ndef add(x):\n    return x + RATE\n\nclass Shape:\n    sides = 3\n    def area(self):\n        return self.sides * 2\n\nclass Square(Shape):\n    pass\n"
STEP = """
import functools
import step_helper
from step_helper import add, Square
from functools import lru_cache

TABLE = {"a": [1, 2]}

def direct(x):
    return add(x)

def through_module(x):
    return step_helper.add(x)

def constant(x):
    return x * step_helper.RATE

def with_class(x):
    return Square().area() * x

def bound(x, shape=Square()):
    return shape.area() * x

def inside(x):
    from step_helper import add as other
    return other(x)

def kept(x):
    return TABLE["a"][0] + x

@lru_cache
def cached(x):
    return add(x)

def wrapped(function):
    @functools.wraps(function)
    def call(*args):
        return function(*args)
    return call

@wrapped
def decorated(x):
    return add(x)

partial = functools.partial(lambda a, b: add(a) + b, 1)

def recursive(x):
    return recursive(x - 1) if x else other_way(x)

def other_way(x):
    return recursive(x) if x else add(x)

def untouched(x):
    return x
"""
CALLS = ["direct", "through_module", "with_class", "bound", "inside", "cached", "decorated", "partial", "recursive"]


@pytest.fixture
def load():
    def make(helper=HELPER, step=STEP):
        for name, source in (("step_helper", helper), ("step_code", step)):
            module = types.ModuleType(name)
            sys.modules[name] = module
            exec(compile(source, f"{name}.py", "exec"), module.__dict__)
        return sys.modules["step_code"]

    yield make
    for name in ("step_helper", "step_code"):
        sys.modules.pop(name, None)


def identities(module, names):
    return {n: code.identity(getattr(module, n)) for n in names}


@pytest.mark.parametrize("old, new, changes", [
    ("x + RATE", "x + RATE + 100", {*CALLS} - {"with_class", "bound"}),
    ("RATE = 1", "RATE = 100", {*CALLS, "constant"} - {"with_class", "bound"}),
    ("sides = 3", "sides = 4", {"with_class", "bound"}),
    ("self.sides * 2", "self.sides * 3", {"with_class", "bound"}),
    ("class Square(Shape):\n    pass", "class Square(Shape):\n    def area(self):\n        return 0", {"with_class", "bound"})])
def test_what_a_step_reaches_in_another_module_counts(load, old, new, changes):
    names = [*CALLS, "constant", "kept", "untouched"]
    before = identities(load(), names)
    assert identities(load(), names) == before
    after = identities(load(helper=HELPER.replace(old, new)), names)
    assert {n for n in names if before[n] != after[n]} == changes


def test_layout_and_comments_do_not_count(load):
    before = identities(load(), CALLS)
    assert identities(load(helper="# a remark\n\n" + HELPER, step="\n\n" + STEP.replace("return x\n", "return x  # as it is\n")), CALLS) == before


def test_values_of_the_own_module_count(load):
    before = code.identity(load().kept)
    assert code.identity(load(step=STEP.replace("[1, 2]", "[1, 3]")).kept) != before


def test_the_same_in_every_process(tmp_path):
    (tmp_path / "step_helper.py").write_text(HELPER)
    (tmp_path / "step_code.py").write_text(STEP)
    script = ("import sys; sys.path[:0] = sys.argv[1:]; import step_code; from factline.operators import code; from factline.plans.documents import document_spec;"
              f"print(code.code_digest(repr([code.identity(getattr(step_code, n)) for n in {CALLS!r}])), document_spec().digest(), code.library_digest())")
    root = str(__import__("pathlib").Path(__file__).parent.parent)
    said = {subprocess.run([sys.executable, "-c", script, str(tmp_path), root], capture_output=True, text=True, check=True,
                           env={"PYTHONHASHSEED": seed, "PATH": "/usr/bin", "HOME": str(tmp_path)}).stdout for seed in ("1", "2")}
    assert len(said) == 1 and len(said.pop().split()) == 3


def test_what_cannot_be_told_is_refused(spark, tmp_path):
    with open(tmp_path / "x", "w") as file:
        for held in (file, spark, object(), spark.range(1)):
            with pytest.raises(ValueError, match="cannot be identified"):
                code.identity(lambda x, held=held: held)


def test_a_changed_grammar_is_another_pipeline(monkeypatch):
    before = documents.document_spec().digest()
    assert documents.document_spec().digest() == before
    monkeypatch.setattr(observations, "page_observations", lambda pages: pages)
    assert documents.document_spec().digest() != before


def test_the_library_is_part_of_a_run(spark, tmp_path, monkeypatch):
    def run():
        spec = ingest.PipelineSpec(id="p", version="1", steps=[("out", "SELECT count(*) AS n FROM {given}")], outputs={"out": "out"})
        return ingest.run(spark, spec, {"given": spark.range(3)}, {}, str(tmp_path), "s")

    first, again = run(), run()
    assert again["reused"] and again["artifact_id"] == first["artifact_id"]
    monkeypatch.setattr(ingest, "library_digest", lambda: code.code_digest("other files"))
    assert not run()["reused"]


def test_a_changed_helper_runs_again(spark, tmp_path, load):
    def run():
        through = sys.modules["step_code"].through_module
        spec = ingest.PipelineSpec(id="p", version="1", steps=[("out", lambda spark, tables: spark.range(through(1)))], outputs={"out": "out"})
        result = ingest.run(spark, spec, {}, {}, str(tmp_path), "s")
        return result["reused"], result["tables"]["out"].count()

    load()
    assert [run(), run()] == [(False, 2), (True, 2)]
    load(helper=HELPER.replace("RATE = 1", "RATE = 5"))
    assert run() == (False, 6)


def test_functions_of_a_run_are_its_own(spark, tmp_path):
    def run(function, root):
        spec = ingest.PipelineSpec(id="p", version="1", steps=[("out", "SELECT shifted(id) AS n FROM {given}")], outputs={"out": "out"},
                                   functions={"shifted": (function, "bigint")})
        return ingest.run(spark, spec, {"given": spark.range(1)}, {}, str(tmp_path / root), "s")["tables"]["out"]

    one, ten = run(lambda x: x + 1, "a"), run(lambda x: x + 10, "a")
    assert (one.first()[0], ten.first()[0]) == (1, 10)
    assert not spark.catalog.functionExists("shifted")
    spark.udf.register("shifted", lambda x: x, "bigint")
    try:
        with pytest.raises(ValueError, match="exist in the session"):
            run(lambda x: x + 100, "b")
        assert spark.catalog.functionExists("shifted")
    finally:
        spark.sql("DROP TEMPORARY FUNCTION shifted")

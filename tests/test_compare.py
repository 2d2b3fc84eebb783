from collections import Counter, defaultdict
from random import Random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from factline.operators import compare

SCHEMA = "item string, category string, value double, evidence_id string"


def facts(spark, seed):
    """Random facts with null keys and one key that holds a third of the rows."""
    random = Random(seed)
    data = []
    for n in range(300):
        item = "hot" if n % 3 == 0 else random.choice(["a", "b", "c", None]) if n % 3 == 1 else f"i{random.randrange(200)}"
        data.append((item, random.choice(["x", None]), random.choice([1.0, 2.0, None]), f"e{n}"))
    return data, spark.createDataFrame(data, SCHEMA)


def test_reconcile_brute_force(spark):
    (old, left), (new, right) = facts(spark, 1), facts(spark, 2)
    sides = [defaultdict(list), defaultdict(list)]
    for side, data in zip(sides, (old, new)):
        for item, category, value, evidence in data:
            side[item, category].append((value, evidence))
    want = []
    for key in set(sides[0]) | set(sides[1]):
        a, b = sides[0][key], sides[1][key]
        if len(a) > 1 or len(b) > 1:
            want.append((*key, len(a), len(b), "duplicate", None, None, None, None, None))
            continue
        (v, e), (w, f) = (a or [(None, None)])[0], (b or [(None, None)])[0]
        status = "added" if not a else "missing" if not b else "unchanged" if v == w else "changed"
        want.append((*key, len(a), len(b), status, v, w, e, f, w - v if None not in (v, w) else None))
    assert rows(compare.reconcile(left, right, ["item", "category"], "value", "evidence_id")) == sorted(want, key=repr)


def test_follow_up_report(spark):
    report = spark.createDataFrame([("A", 15.0), ("B", 25.0)], "item string, value double")
    follow_up = spark.createDataFrame([("A", 18.0), ("B", 24.0), ("C", 5.0)], "item string, value double")
    got = rows(compare.reconcile(report, follow_up, ["item"], "value"), "item", "status", "delta")
    assert got == [("A", "changed", 3.0), ("B", "changed", -1.0), ("C", "added", None)]


def test_unmatched_brute_force(spark):
    (old, left), (new, right) = facts(spark, 3), facts(spark, 4)
    a, b = Counter(t[:2] for t in old), Counter(t[:2] for t in new)
    want = (len(a.keys() - b.keys()), sum(n for k, n in a.items() if k not in b), len(b.keys() - a.keys()),
            sum(n for k, n in b.items() if k not in a), len(a.keys() & b.keys()))
    assert tuple(compare.unmatched(left, right, ["item", "category"]).first()) == want


def test_supplement(spark):
    history = spark.createDataFrame([("A", 10, None), ("B", 20, None), ("C", 1, "kept"), ("D", 2, None), (None, 3, None)],
                                    "item string, value int, category string")
    supplement = spark.createDataFrame([("A", "retail"), ("B", "wholesale"), ("A", "retail"), ("C", "other"), ("D", "x"), ("D", "y")],
                                       "item string, category string")
    got = rows(compare.fill_missing(history, supplement, ["item"], ["category"]))
    assert got == sorted([("A", 10, "retail", True), ("B", 20, "wholesale", True), ("C", 1, "kept", False), ("D", 2, None, False),
                          (None, 3, None, False)], key=repr)


def test_duplicates_conflicts_and_profile(spark):
    data, df = facts(spark, 5)
    counts = Counter(t[:2] for t in data)
    assert rows(compare.duplicate_keys(df, ["item", "category"])) == sorted([(*k, n) for k, n in counts.items() if n > 1], key=repr)
    values = defaultdict(Counter)
    for item, _, value, _ in data:
        values[item][value] += 1
    want = [(k, v, n, len(c), sum(c.values())) for k, c in values.items() if len(c) > 1 for v, n in c.items()]
    assert rows(compare.conflicts(df, ["item"])) == sorted(want, key=repr)
    got = {r["column_name"]: r for r in compare.profile(df).collect()}
    items = [t[0] for t in data]
    assert (got["item"]["rows"], got["item"]["nulls"], got["item"]["distinct_values"]) == (
        300, items.count(None), len(set(items) - {None}))
    assert got["item"]["max_text"] == max(i for i in items if i is not None)
    empty = compare.profile(df.filter("false"), ["value"]).first()
    assert (empty["rows"], empty["nulls"], empty["distinct_values"], empty["min_text"]) == (0, 0, 0, None)


def test_coverage(spark):
    df = spark.createDataFrame([("g", 1, "a"), ("g", 1, "a"), ("g", 2, "a"), ("g", 1, "b"), ("g", 2, "c"), ("g", 3, "d"), ("h", 2, "a")],
                               "g string, p int, k string")
    assert rows(compare.coverage(df, ["g"], "p", "k", (1, 2), (2, 3))) == [("g", 2, 2, 1, 1, 1), ("h", 0, 1, 0, 0, 1)]


def test_evidence_gaps(spark):
    data, df = facts(spark, 6)
    facts_df = df.withColumn("asset_id", F.lit("s"))
    evidence = spark.createDataFrame([(f"e{n}", "s", "{}", "q") for n in range(0, 300, 2)],
                                     "evidence_id string, asset_id string, locator_json string, quote string")
    cited = compare.with_evidence(facts_df, evidence)
    assert (cited.count(), cited.filter("evidence_gap").count()) == (300, 150)


def test_versions_are_kept(spark):
    first = spark.createDataFrame([("A", 10.0), ("B", 20.0)], "item string, value double")
    stacked = compare.versions({"one": first, "two": first.withColumn("value", F.col("value") * 2)})
    sums = dict(map(tuple, stacked.groupBy("run_id").agg(F.sum("value")).collect()))
    assert sums == {"one": 30.0, "two": 60.0}
    assert compare.version_changes(stacked, ["item"], "one", "two").count() == 2


@pytest.mark.parametrize("operator", ["reconcile", "unmatched"])
def test_comparison_needs_no_join(spark, operator):
    _, left = facts(spark, 7)
    args = (["item"], "value") if operator == "reconcile" else (["item"],)
    plan = getattr(compare, operator)(left, left, *args)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan

"""Histories against the runs they were made of."""

import random
from collections import Counter

import pytest

from factline.operators import history

SCHEMA = "item string, category string, value int"


def runs_of(seed, n=6):
    rng = random.Random(seed)
    rows, runs = [], []
    for _ in range(n):
        for _ in range(rng.randint(0, 8)):
            rows.append((rng.choice("abc"), rng.choice(["x", None]), rng.choice([1, 2, None])))
        rng.shuffle(rows)
        rows = rows[:rng.choice([0, len(rows), len(rows) * 2 // 3, len(rows)])]
        runs.append(list(rows))
    return runs


@pytest.mark.parametrize("seed", [1, 2])
def test_any_run_is_rebuilt(spark, tmp_path, seed):
    runs, folder = runs_of(seed), str(tmp_path / "log")
    for run, rows in enumerate(runs):
        history.add_run(spark, folder, spark.createDataFrame(rows, SCHEMA), run)
        if run == 3:  # again, after a failure
            history.add_run(spark, folder, spark.createDataFrame(rows, SCHEMA), run)
    log = history.changes(spark, folder, spark.createDataFrame([], SCHEMA).schema)
    before = Counter()
    written = Counter(r["run"] for r in log.collect())
    held = [tuple(r) for r in history.intervals(log).collect()]
    for run, rows in enumerate(runs):
        now = Counter(rows)
        assert Counter(map(tuple, history.rebuild(log, run).collect())) == now
        assert Counter({r[:3]: r[3] for r in held if r[4] <= run and (r[5] is None or run < r[5])}) == now
        assert written[run] == sum(now[r] != before[r] for r in now | before)  # changed rows only
        before = now
    for row, copies, first, last in ((r[:3], *r[3:]) for r in held):  # intervals are as long as they can be
        assert last is None or Counter(runs[last])[row] != copies
        assert first == 0 or Counter(runs[first - 1])[row] != copies


def test_what_held_at_a_run(spark, tmp_path):
    runs, folder = runs_of(3), str(tmp_path / "log")
    for run, rows in enumerate(runs):
        history.add_run(spark, folder, spark.createDataFrame(rows, SCHEMA), run)
    log = history.changes(spark, folder, spark.createDataFrame([], SCHEMA).schema)
    asked = [(i, c, r) for i in "abz" for c in ("x", None) for r in range(6)]
    got = history.as_of(log, spark.createDataFrame(asked, "item string, category string, at bigint"), ["item", "category"], "at")
    want = [(r, *row, n) for i, c, r in asked for row, n in Counter(runs[r]).items() if row[:2] == (i, c)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_names_that_a_history_needs_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="named otherwise"):
        history.add_run(spark, str(tmp_path), spark.createDataFrame([(1, 2)], "run int, other int"), 0)

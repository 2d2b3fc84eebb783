"""Replies are asked for once."""

import json
import os

import pytest
from pyspark.sql import functions as F

from factline.operators import replies


@pytest.fixture
def counter(tmp_path):
    """A reply function that leaves a file for every call, and the calls so far."""
    (tmp_path / "calls").mkdir()
    folder = str(tmp_path / "calls")

    def reply(request):
        import os
        import uuid

        if os.path.exists(f"{folder}/../down") and request.startswith("bad"):
            raise RuntimeError("the model is down")
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
            file.write(request)
        return request.upper()

    def calls():
        return sorted((tmp_path / "calls" / n).read_text() for n in os.listdir(folder))

    return reply, calls


def test_equal_and_known_requests_are_not_asked_again(spark, tmp_path, counter):
    reply, calls = counter
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, request string")
    got = replies.with_replies(first, reply, str(tmp_path / "memo"), calls_per_task=1)
    assert sorted(map(tuple, got.select("id", "reply").collect()), key=repr) == [(1, "A"), (2, "B"), (3, "A"), (4, None)]
    assert calls() == ["a", "b"]
    more = first.unionByName(spark.createDataFrame([(5, "c")], "id int, request string"))
    assert replies.with_replies(more, reply, str(tmp_path / "memo")).filter("reply IS NOT NULL").count() == 4
    assert replies.with_replies(first.limit(0), reply, str(tmp_path / "memo")).count() == 0
    assert calls() == ["a", "b", "c"]
    replies.with_replies(first, lambda request: reply(request) + "!", str(tmp_path / "memo"))  # another function
    assert calls() == ["a", "a", "b", "b", "c"]


def test_a_failed_run_keeps_the_replies_of_its_tasks(spark, tmp_path, counter):
    reply, calls = counter
    asked = spark.createDataFrame([(i, f"{'bad' if i == 5 else 'request'} {i:02}") for i in range(24)], "id int, request string")
    (tmp_path / "down").write_text("")
    with pytest.raises(Exception, match="the model is down"):
        replies.with_replies(asked, reply, str(tmp_path / "memo"), "first", calls_per_task=1, threads=1)
    held = replies.stored(spark, replies.store_of(str(tmp_path / "memo"), reply)).count()
    before = len(calls())
    assert held > 0
    (tmp_path / "down").unlink()
    got = replies.with_replies(asked, reply, str(tmp_path / "memo"), "second", calls_per_task=1, threads=1)
    assert got.filter(F.upper("request") == F.col("reply")).count() == 24
    assert len(calls()) - before == 24 - held
    runs = replies.stored(spark, replies.store_of(str(tmp_path / "memo"), reply)).groupBy("run").count().collect()
    assert {r["run"]: r["count"] for r in runs} == {"first": held, "second": 24 - held}


def test_tasks_get_calls_of_like_cost(spark, tmp_path):
    def reply(request):
        import os

        from pyspark import TaskContext

        return json.dumps([TaskContext.get().partitionId() if TaskContext.get() else os.getpid(), len(request)])

    asked = spark.createDataFrame([("x" * (1 + 37 * i % 1000) + str(i),) for i in range(120)], "request string")
    got = [json.loads(r["reply"]) for r in replies.with_replies(asked, reply, str(tmp_path / "memo"), calls_per_task=30, threads=1).collect()]
    costs = {}
    for task, cost in got:
        costs[task] = costs.get(task, 0) + cost
    assert len(costs) == 4 and max(costs.values()) < 1.2 * min(costs.values())

"""Checkpoints that continue others: what is written, what is restored, what is refused."""

import glob
import os
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from factline.operators.checks import ContractError
from factline.plans import checkpoints
from factline.plans.workspace import Workspace

SCHEMA = "k int, _bucket string, v double, b binary, l array<int>"
ROWS = [(i, f"text {i}" if i % 3 else None, None if i % 5 else i / 3, bytes([i % 256]), [i, None]) for i in range(300)] + [
    (None, None, None, None, None)] * 40  # a hot null key


def written(root, checkpoint, name="t"):
    """The buckets that a checkpoint wrote itself."""
    return {p.rsplit("=", 1)[1] for p in glob.glob(f"{root}/checkpoints/data/{checkpoint}/outputs/{name}/*=*")}


def save(spark, root, made, after=None, **more):
    return checkpoints.save_changed(spark, {"t": spark.createDataFrame(made, SCHEMA)}, root, "scope", after,
                                    **{"keys": {"t": ["k"]}, "buckets": 16, **more})


def restored(spark, root, checkpoint):
    return rows(checkpoints.restore(spark, root, checkpoint, "scope")["t"])


def test_a_changed_row_rewrites_its_bucket_only(spark, tmp_path):
    root = str(tmp_path)
    first = save(spark, root, ROWS)
    changed = [(7, "other", *r[2:]) if r[0] == 7 else r for r in ROWS]
    states = [ROWS, list(reversed(ROWS)), changed, [r for r in changed if r[0] != 9], changed]
    ids = [first]
    for state in states[1:]:
        ids.append(save(spark, root, state, after=ids[-1]))
    assert len(written(root, first)) == 16
    assert [len(written(root, i)) for i in ids[1:]] == [0, 1, 1, 1]
    for state, checkpoint in zip(states, ids):
        assert restored(spark, root, checkpoint) == sorted((tuple(r) for r in spark.createDataFrame(state, SCHEMA).collect()), key=repr)


def test_rows_without_a_key_other_layouts_and_empty_tables(spark, tmp_path):
    root = str(tmp_path)
    first = save(spark, root, ROWS, keys=None)
    second = save(spark, root, [(7, "other", *r[2:]) if r[0] == 7 else r for r in ROWS], after=first, keys=None)
    assert 1 <= len(written(root, second)) <= 2  # where the row was, and where it is
    assert len(written(root, save(spark, root, ROWS, after=first))) == 16  # by key now: all anew
    fewer = save(spark, root, ROWS, after=first, keys=None, buckets=4)
    assert len(written(root, fewer)) == 4
    whole = checkpoints.save(spark, {"t": spark.createDataFrame(ROWS, SCHEMA)}, root, "scope")
    assert len(written(root, save(spark, root, ROWS, after=whole))) == 16
    none = save(spark, root, [], after=first)
    assert written(root, none) == set() and restored(spark, root, none) == []
    assert restored(spark, root, save(spark, root, ROWS, after=none)) == restored(spark, root, first)
    with pytest.raises(ValueError, match="no columns"):
        save(spark, root, ROWS, keys={"t": ["gone"]})
    with pytest.raises(ContractError, match="not found"):
        save(spark, root, ROWS, after="gone")


def test_a_hot_bucket_is_written_by_several_tasks(spark, tmp_path):
    root = str(tmp_path)
    hot = spark.range(60_000).select(F.lit(1).alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        saved = checkpoints.save_changed(spark, {"t": hot}, root, "scope", keys={"t": ["k"]})
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(written(root, saved)) == 1
    assert len(glob.glob(f"{root}/checkpoints/data/{saved}/outputs/t/*=*/*.parquet")) > 1
    assert checkpoints.restore(spark, root, saved, "scope")["t"].distinct().count() == 60_000


def test_buckets_of_earlier_checkpoints_are_verified(spark, tmp_path):
    root = str(tmp_path)
    first = save(spark, root, ROWS)
    second = save(spark, root, ROWS[1:], after=first)
    assert len(written(root, second)) == 1
    kept = sorted(written(root, first) - written(root, second))[0]
    path = glob.glob(f"{root}/checkpoints/data/{first}/outputs/t/*={kept}/*.parquet")[0]
    copy = os.path.join(os.path.dirname(path), "copy.parquet")
    shutil.copyfile(path, copy)  # a bucket with its rows twice
    with pytest.raises(ContractError, match=f"bucket {kept} of t"):
        checkpoints.restore(spark, root, second, "scope")


def test_a_workspace_continues_its_checkpoint(spark, tmp_path):
    data, root = str(tmp_path / "in.parquet"), str(tmp_path / "store")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").coalesce(1).write.parquet(data)
    work = Workspace(spark, root)
    work.load_file(data, "t", glob="*.parquet")
    first = work.checkpoint(["t"], keys={"t": ["k"]})
    work.sql("SELECT k, if(k = 2, 'c', v) AS v FROM t", name="t")
    second = work.checkpoint(["t"], after=first, keys={"t": ["k"]})
    assert len(written(root, second)) == 1 and written(root, second, checkpoints.ASSETS) == set()
    again = Workspace(spark, root)
    assert set(again.restore(second)) == {"t"} and again.assets.count() == 1
    assert rows(again.tables["t"]) == [(1, "a"), (2, "c")]
    assert again.changed_sources().count() == 0

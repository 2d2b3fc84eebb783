from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from factline.operators.numbering import number_all, number_within, running_totals


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows in one group, many of them equal."""
    return spark.range(0, 4000, 1, 6).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") * 37) % 501).alias("v"), (F.col("id") % 5).alias("w"))


def test_numbers_agree_with_a_window(spark, skewed):
    plain = skewed.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("v", "w")) + 1)
    split = number_within(skewed, ["g"], ["v", "w"], start=2)
    assert rows(plain) == rows(split)
    assert split.groupBy("g").agg((F.countDistinct("n") == F.count("*")).alias("dense"), F.min("n").alias("low")).filter(
        "NOT dense OR low <> 2").count() == 0


def test_hot_group_is_spread(spark, skewed):
    split = number_within(skewed, ["g"], ["v", "w"])
    hot = split.filter("g = 'hot' AND v = 7 AND w = 0")
    assert hot.count() > 100
    numbers = sorted(r["n"] for r in split.filter("g = 'hot'").collect())
    assert numbers == list(range(1, len(numbers) + 1))


def test_global_numbers_are_dense_and_ordered(skewed):
    numbered = [tuple(r) for r in number_all(skewed, ["v", "w"]).select("_row", "v", "w").collect()]
    numbered.sort()
    assert [n for n, _, _ in numbered] == list(range(4000))
    assert [t[1:] for t in numbered] == sorted(t[1:] for t in numbered)


def test_running_totals_cross_blocks(spark):
    data = [(k, n, (n * 7) % 11, n if n % 4 == 0 else None) for k, top in (("a", 100), ("b", 3)) for n in range(1, top + 1)]
    df = spark.createDataFrame(data, "k string, n bigint, v bigint, mark bigint")
    got = running_totals(df, "k", "n", {"upto": "v"}, {"seen": "mark"}, block=8)
    want, totals, last = [], Counter(), {}
    for k, n, v, mark in data:
        totals[k] += v
        last[k] = mark if mark is not None else last.get(k)
        want.append((k, n, v, mark, totals[k], last[k]))
    assert rows(got) == sorted(want, key=repr)

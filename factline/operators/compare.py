"""Comparison of observation sets: changes, gaps, duplicates, coverage and conflicts.

Sides are stacked and reduced by key in one conditional aggregate instead of being joined.
Rows of a hot key are combined before the shuffle, null keys match each other, and a key
that is duplicated on both sides never produces pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _stack(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    picked = [*keys, *columns]
    return left.select(*picked, F.lit(True).alias("_old")).unionByName(
        right.select(*picked, F.lit(False).alias("_old"))
    )


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], value: str, evidence: str | None = None) -> DataFrame:
    """Status of each key between an earlier (`left`) and a later (`right`) observation set.

    `duplicate` marks a key that is not unique on one side; its values are not compared.
    """
    old, new = F.col("_old"), ~F.col("_old")
    extra = [evidence] if evidence else []

    def one(column: str, side: Column) -> Column:
        return F.max(F.when(side, F.col(column)))

    aggregates = [
        F.count_if(old).alias("old_rows"), F.count_if(new).alias("new_rows"),
        one(value, old).alias("old_value"), one(value, new).alias("new_value"),
    ]
    if evidence:
        aggregates += [one(evidence, old).alias("old_evidence"), one(evidence, new).alias("new_evidence")]
    keyed = _stack(left, right, keys, [value, *extra]).groupBy(*keys).agg(*aggregates)
    duplicate = (F.col("old_rows") > 1) | (F.col("new_rows") > 1)
    status = (
        F.when(duplicate, "duplicate")
        .when(F.col("old_rows") == 0, "added")
        .when(F.col("new_rows") == 0, "missing")
        .when(F.col("old_value").eqNullSafe(F.col("new_value")), "unchanged")
        .otherwise("changed")
    )
    shown = [F.when(~duplicate, F.col(c)).alias(c) for c in keyed.columns if c.startswith(("old_v", "new_v", "old_e", "new_e"))]
    return keyed.select(*keys, "old_rows", "new_rows", status.alias("status"), *shown).withColumn(
        "delta", F.col("new_value") - F.col("old_value")
    )


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and rows of each side that have no partner on the other."""
    keyed = _stack(left, right, keys, []).groupBy(*keys).agg(
        F.count_if(F.col("_old")).alias("_l"), F.count_if(~F.col("_old")).alias("_r")
    )
    return keyed.agg(
        F.count_if(F.col("_r") == 0).alias("left_only_keys"),
        F.coalesce(F.sum(F.when(F.col("_r") == 0, F.col("_l"))), F.lit(0)).alias("left_only_rows"),
        F.count_if(F.col("_l") == 0).alias("right_only_keys"),
        F.coalesce(F.sum(F.when(F.col("_l") == 0, F.col("_r"))), F.lit(0)).alias("right_only_rows"),
        F.count_if((F.col("_l") > 0) & (F.col("_r") > 0)).alias("matched_keys"),
    )


def fill_missing(df: DataFrame, supplement: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Fill nulls from a supplement when it says exactly one thing about the key.

    The supplement is reduced to one row per key first, so the join never multiplies rows;
    Spark broadcasts it only when its measured size allows.
    """
    told = supplement.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        *[F.when(F.min(c).eqNullSafe(F.max(c)), F.max(c)).alias(f"_s_{c}") for c in columns]
    )
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    # A row with a null key matches nothing; it stays out of the join, where all of them would meet in one task.
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    alone = df.filter(~whole).select("*", *[F.lit(None).cast(told.schema[f"_s_{c}"].dataType).alias(f"_s_{c}") for c in columns])
    joined = df.filter(whole).join(told, same, "left").drop(*[f"_k{i}" for i in range(len(keys))]).unionByName(alone)
    filled = {c: F.coalesce(F.col(c), F.col(f"_s_{c}")) for c in columns}
    flags = [(F.col(c).isNull() & F.col(f"_s_{c}").isNotNull()).alias(f"{c}_filled") for c in columns]
    return joined.select(*[filled.get(c, F.col(c)).alias(c) for c in df.columns], *flags)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, nulls, exact distinct values and range of every column, one output row per column.

    Each column is reduced to its values and their counts, then to one row. A columnar source
    is read one column at a time and equal values are combined before the shuffle, so a
    value that fills a third of the table costs nothing. Store a costly plan first.
    """
    reports = []
    for name in columns or df.columns:
        value = F.col("value")
        counted = df.select(F.col(name).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        reports.append(counted.agg(
            F.lit(name).alias("column_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(value.isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
            F.min("value").cast("string").alias("min_text"),
            F.max("value").cast("string").alias("max_text"),
        ))
    stacked = reports[0]
    for report in reports[1:]:
        stacked = stacked.unionByName(report)
    return stacked


def coverage(df: DataFrame, group: list[str], period: str, key: str, old, new) -> DataFrame:
    """How many keys of each group were seen in the old period, the new one, or both.

    Periods are `(start, end)` ranges of the column, the end not included, so that they reach the scan.
    """
    within = lambda span: (F.col(period) >= F.lit(span[0])) & (F.col(period) < F.lit(span[1]))
    seen = (
        df.filter(within(old) | within(new))
        .groupBy(*group, key)
        .agg(F.max(within(old)).alias("_old"), F.max(within(new)).alias("_new"))
    )
    return seen.groupBy(*group).agg(
        F.count_if("_old").alias("old_keys"), F.count_if("_new").alias("new_keys"),
        F.count_if(F.col("_old") & F.col("_new")).alias("kept_keys"),
        F.count_if(F.col("_old") & ~F.col("_new")).alias("lost_keys"),
        F.count_if(~F.col("_old") & F.col("_new")).alias("gained_keys"),
    )


def conflicts(facts: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Every distinct value of the keys that have more than one, with its observation count.

    The values stay side by side as rows. A first pass, combined before its shuffle, finds the
    keys whose least and greatest values differ or that have both nulls and values; only rows
    of these keys are joined and counted by value.
    """
    both = (F.min(value) != F.max(value)) | ((F.count(value) > 0) & (F.count(value) < F.count(F.lit(1))))
    several = (
        facts.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        .agg(both.alias("_both"), F.count(F.lit(1)).alias("key_observations")).filter("_both")
    )
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    values = facts.join(several, same).groupBy(*keys, value, "key_observations").agg(F.count(F.lit(1)).alias("observations"))
    counted = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return values.select(*keys, value, "observations", counted.alias("distinct_values"), "key_observations")


def with_evidence(facts: DataFrame, evidence: DataFrame) -> DataFrame:
    """Facts with the locator and quote that support them; a gap leaves both null."""
    cited = evidence.select("evidence_id", "asset_id", "locator_json", "quote", F.lit(True).alias("_cited"))
    return facts.join(cited, ["evidence_id", "asset_id"], "left").select(
        *facts.columns, "locator_json", "quote", F.col("_cited").isNull().alias("evidence_gap")
    )


def versions(runs: dict[str, DataFrame]) -> DataFrame:
    """Facts of several runs in one table, each row marked with its run."""
    marked = [df.select(F.lit(run).alias("run_id"), *df.columns) for run, df in runs.items()]
    stacked = marked[0]
    for df in marked[1:]:
        stacked = stacked.unionByName(df)
    return stacked


def version_changes(stacked: DataFrame, keys: list[str], first: str, last: str, value: str = "value") -> DataFrame:
    """Keys whose value differs between two runs, or that only one run reports."""
    old = stacked.filter(F.col("run_id") == first)
    new = stacked.filter(F.col("run_id") == last)
    return reconcile(old, new, keys, value).filter(F.col("status") != "unchanged")

"""Comparison of observation sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from factline.operators import compare, history
from factline.queries.registry import on_tables, order_facts, query, table
from factline.storage import fresh_path

SIDES = """
  WITH old AS (SELECT o_custkey AS item, o_orderpriority AS category, count(*) AS n, max(o_totalprice) AS value,
                      max('order:' || o_orderkey) AS evidence FROM orders
               WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' GROUP BY ALL),
       new AS (SELECT o_custkey AS item, o_orderpriority AS category, count(*) AS n, max(o_totalprice) AS value,
                      max('order:' || o_orderkey) AS evidence FROM orders
               WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY ALL)"""


@query("q_reconcile", SIDES + """
  , j AS (SELECT coalesce(old.item, new.item) AS item, coalesce(old.category, new.category) AS category,
                 coalesce(old.n, 0) AS old_rows, coalesce(new.n, 0) AS new_rows, old.value AS ov, new.value AS nv,
                 old.evidence AS oe, new.evidence AS ne, coalesce(old.n, 0) > 1 OR coalesce(new.n, 0) > 1 AS dup
          FROM old FULL JOIN new ON old.item = new.item AND old.category = new.category)
  SELECT item, category, old_rows, new_rows,
         CASE WHEN dup THEN 'duplicate' WHEN old_rows = 0 THEN 'added' WHEN new_rows = 0 THEN 'missing'
              WHEN ov = nv THEN 'unchanged' ELSE 'changed' END AS status,
         CASE WHEN NOT dup THEN ov END AS old_value, CASE WHEN NOT dup THEN nv END AS new_value,
         CASE WHEN NOT dup THEN oe END AS old_evidence, CASE WHEN NOT dup THEN ne END AS new_evidence,
         CASE WHEN NOT dup THEN nv - ov END AS delta
  FROM j""")
def reconcile(spark, sf_dir):
    return compare.reconcile(order_facts(spark, sf_dir, 1996), order_facts(spark, sf_dir, 1997),
                             ["item", "category"], "value", "evidence_id")


@query("q_unmatched", SIDES + """
  SELECT count(*) FILTER (WHERE new.item IS NULL) AS left_only_keys,
         CAST(coalesce(sum(old.n) FILTER (WHERE new.item IS NULL), 0) AS BIGINT) AS left_only_rows,
         count(*) FILTER (WHERE old.item IS NULL) AS right_only_keys,
         CAST(coalesce(sum(new.n) FILTER (WHERE old.item IS NULL), 0) AS BIGINT) AS right_only_rows,
         count(*) FILTER (WHERE old.item IS NOT NULL AND new.item IS NOT NULL) AS matched_keys
  FROM old FULL JOIN new ON old.item = new.item AND old.category = new.category""")
def unmatched(spark, sf_dir):
    return compare.unmatched(order_facts(spark, sf_dir, 1996), order_facts(spark, sf_dir, 1997), ["item", "category"])


@query("q_supplement_fill", """
  WITH told AS (SELECT item, CASE WHEN min(category) = max(category) THEN max(category) END AS category
                FROM (SELECT p_partkey AS item, p_brand AS category FROM part
                      UNION ALL SELECT p_partkey, p_type FROM part WHERE p_size < 3) GROUP BY item)
  SELECT l_partkey AS item, l_quantity AS value, coalesce(nullif(l_returnflag, 'N'), told.category) AS category,
         nullif(l_returnflag, 'N') IS NULL AND told.category IS NOT NULL AS category_filled
  FROM lineitem LEFT JOIN told ON l_partkey = told.item""")
def supplement_fill(spark, sf_dir):
    facts = on_tables(spark, sf_dir, """
      SELECT l_partkey AS item, l_quantity AS value, nullif(l_returnflag, 'N') AS category FROM {lineitem}""")
    supplement = on_tables(spark, sf_dir, """
      SELECT p_partkey AS item, p_brand AS category FROM {part}
      UNION ALL SELECT p_partkey, p_type FROM {part} WHERE p_size < 3""")
    return compare.fill_missing(facts, supplement, ["item"], ["category"])


@query("q_dup_keys", """
  SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_keys(spark, sf_dir):
    return compare.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _profile_sql(relation: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values, "
        f"CAST(min({c}) AS VARCHAR) AS min_text, CAST(max({c}) AS VARCHAR) AS max_text FROM {relation}" for c in columns)


@query("q_null_profile", _profile_sql(
    "(SELECT l_suppkey, l_partkey, l_quantity, nullif(l_returnflag, 'N') AS category, l_shipdate FROM lineitem)",
    ["l_suppkey", "l_partkey", "l_quantity", "category", "l_shipdate"]))
def null_profile(spark, sf_dir):
    return compare.profile(on_tables(spark, sf_dir, """
      SELECT l_suppkey, l_partkey, l_quantity, nullif(l_returnflag, 'N') AS category, l_shipdate FROM {lineitem}"""))


@query("q_coverage_change", """
  WITH seen AS (SELECT o_orderpriority, o_custkey, bool_or(year(o_orderdate) = 1996) AS o, bool_or(year(o_orderdate) = 1997) AS n
                FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY 1, 2)
  SELECT o_orderpriority, count(*) FILTER (WHERE o) AS old_keys, count(*) FILTER (WHERE n) AS new_keys,
         count(*) FILTER (WHERE o AND n) AS kept_keys, count(*) FILTER (WHERE o AND NOT n) AS lost_keys,
         count(*) FILTER (WHERE n AND NOT o) AS gained_keys
  FROM seen GROUP BY 1""")
def coverage_change(spark, sf_dir):
    starts = [F.lit(f"{year}-01-01").cast("timestamp_ntz") for year in (1996, 1997, 1998)]
    old, new = starts[:2], starts[1:]
    return compare.coverage(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderdate", "o_custkey", old, new)


@query("q_conflicts", """
  WITH v AS (SELECT l_orderkey, l_linenumber, l_quantity, count(*) AS observations FROM lineitem GROUP BY 1, 2, 3)
  SELECT l_orderkey, l_linenumber, l_quantity, observations, n AS distinct_values, s AS key_observations
  FROM v JOIN (SELECT l_orderkey AS o, l_linenumber AS l, count(*) AS n, CAST(sum(observations) AS BIGINT) AS s
               FROM v GROUP BY 1, 2 HAVING count(*) > 1)
    ON o = l_orderkey AND l = l_linenumber""")
def conflicts(spark, sf_dir):
    return compare.conflicts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_quantity")


@query("q_fact_versions", """
  SELECT run_id, category, count(*) AS facts, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total
  FROM (SELECT 'run-1' AS run_id, o_orderpriority AS category, o_totalprice AS value FROM orders
        UNION ALL SELECT 'run-2', o_orderpriority, o_totalprice * 2 FROM orders)
  GROUP BY 1, 2""")
def fact_versions(spark, sf_dir):
    facts = order_facts(spark, sf_dir)
    stacked = compare.versions({"run-1": facts, "run-2": facts.withColumn("value", F.col("value") * 2)})
    return stacked.groupBy("run_id", "category").agg(
        F.count(F.lit(1)).alias("facts"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


@query("q_version_changes", """
  SELECT 'order:' || o_orderkey AS evidence_id, CAST(1 AS BIGINT) AS old_rows, CAST(1 AS BIGINT) AS new_rows, 'changed' AS status,
         o_totalprice AS old_value, o_totalprice * 2 AS new_value, o_totalprice * 2 - o_totalprice AS delta
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT 'order:' || o_orderkey, 1, 0, 'missing', o_totalprice, NULL, NULL FROM orders WHERE o_orderstatus = 'P'""")
def version_changes(spark, sf_dir):
    first = on_tables(spark, sf_dir, """
      SELECT concat('order:', o_orderkey) AS evidence_id, o_totalprice AS value FROM {orders}""")
    second = on_tables(spark, sf_dir, """
      SELECT concat('order:', o_orderkey) AS evidence_id,
             CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS value
      FROM {orders} WHERE o_orderstatus <> 'P'""")
    return compare.version_changes(compare.versions({"run-1": first, "run-2": second}), ["evidence_id"], "run-1", "run-2")


# Run by run the orders so far are counted for each customer and priority; a count holds until the next order.
@query("q_fact_history", """
  WITH years AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
  runs AS (SELECT y, row_number() OVER (ORDER BY y) - 1 AS run FROM years),
  counted AS (
    SELECT r.run, o_custkey AS item, o_orderpriority AS category, count(*) AS orders
    FROM runs r JOIN orders ON year(o_orderdate) <= r.y GROUP BY ALL),
  islands AS (SELECT *, run - row_number() OVER (PARTITION BY item, category, orders ORDER BY run) AS island FROM counted)
  SELECT item, category, orders, CAST(1 AS BIGINT) AS copies, min(run) AS from_run,
         CASE WHEN max(run) < (SELECT max(run) FROM runs) THEN max(run) + 1 END AS to_run
  FROM islands GROUP BY item, category, orders, island""")
def fact_history(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", F.year("o_orderdate").alias("y"))
    first, last = orders.agg(F.min("y"), F.max("y")).first()
    folder = fresh_path(spark, "history")
    made = None
    for run, year in enumerate(range(first, last + 1)):
        made = orders.filter(F.col("y") <= year).groupBy(F.col("o_custkey").alias("item"), F.col("o_orderpriority").alias("category")).agg(
            F.count(F.lit(1)).alias("orders"))
        history.add_run(spark, folder, made, run)
    return history.intervals(history.changes(spark, folder, made.schema))

"""Digests, recipes, published artifacts, checkpoints, paging, catalog and functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from factline.operators import lineage, versions
from factline.plans import checkpoints, ingest, oplog, results
from factline.plans.results import store_result
from factline.queries.registry import ORACLES, on_tables, query, table
from factline.sources import artifacts
from factline.storage import fresh_path

_ROW = """'{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":' || to_json(props)
       || ',"ts":"' || CAST(ts AS VARCHAR) || '","user_id":' || user_id || ',"value":' || CAST(value AS VARCHAR) || '}'"""
_DIGESTED = " || ".join(
    f"CASE WHEN {c} IS NULL THEN 'n' ELSE length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    for c in ("event_id", "ts", "user_id", "event_type", "value", "props"))
_TYPES = ('[["event_id","bigint"],["ts","timestamp_ntz"],["user_id","bigint"],["event_type","string"],["value","double"],["props","string"]]')


@query("q_content_digest", f"""
  WITH h AS (SELECT sha256({_DIGESTED}) AS h FROM events),
  s AS (SELECT count(*) AS n, sum(CAST('0x' || substr(h, 1, 15) AS HUGEINT)) AS a, sum(CAST('0x' || substr(h, 16, 15) AS HUGEINT)) AS b FROM h)
  SELECT n AS rows, sha256('{_TYPES}' || ':' || n || ':' || CAST(a AS VARCHAR) || ':' || CAST(b AS VARCHAR)) AS digest FROM s""")
def content_digest(spark, sf_dir):
    return versions.content_digest(table(spark, sf_dir, "events"))


@query("q_canonical_json", f"SELECT event_id, {_ROW} AS row_json FROM events")
def canonical_json(spark, sf_dir):
    from factline.functions.canonical import canonical_row

    events = table(spark, sf_dir, "events")
    return events.select("event_id", canonical_row(events.schema).alias("row_json"))


# A run asks for a customer's input and a state; every order is an artifact published for one.
@query("q_recipe_index", """
  WITH index AS (
    SELECT sha256('{"input":"' || o_custkey || '","params":"' || o_orderstatus || '"}') AS recipe_hash,
           'order-' || o_orderkey AS artifact_id, o_orderpriority AS content_digest,
           row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, 'order-' || o_orderkey) AS r
    FROM orders QUALIFY r = 1),
  runs AS (SELECT c_custkey, 'F' AS params, sha256('{"input":"' || c_custkey || '","params":"F"}') AS recipe_hash FROM customer)
  SELECT c_custkey, recipe_hash, artifact_id,
         CASE WHEN artifact_id IS NULL THEN 'run' WHEN content_digest = '1-URGENT' THEN 'reuse tables' ELSE 'reload artifact' END AS action
  FROM runs LEFT JOIN index USING (recipe_hash)""")
def recipe_index(spark, sf_dir):
    index = on_tables(spark, sf_dir, """
      SELECT CAST(o_custkey AS STRING) AS input, o_orderstatus AS params, concat('order-', o_orderkey) AS artifact_id,
             o_orderpriority AS content_digest, o_orderdate AS created_at FROM {orders}""")
    runs = on_tables(spark, sf_dir, """
      SELECT c_custkey, CAST(c_custkey AS STRING) AS input, 'F' AS params, '1-URGENT' AS current_digest FROM {customer}""")
    recipe = versions.recipe_column("input", "params")
    return versions.find_reusable(runs.withColumn("recipe_hash", recipe), index.withColumn("recipe_hash", recipe)).select(
        "c_custkey", "recipe_hash", "artifact_id", "action")


@query("q_artifact_roundtrip", "SELECT * FROM orders")
def artifact_roundtrip(spark, sf_dir):
    root = fresh_path(spark, "store")
    recipe = {"input_tables": {"orders": sf_dir}}
    key = versions.recipe_hash(recipe)
    manifest = artifacts.publish(spark, {"orders": table(spark, sf_dir, "orders")}, root, "local", recipe, key,
                                 {"id": "orders", "version": "1", "digest": versions.code_digest("orders")})
    return artifacts.load(spark, root, manifest["artifact_id"], "local")["orders"]


@query("q_checkpoint_roundtrip", "SELECT * FROM customer")
def checkpoint_roundtrip(spark, sf_dir):
    root = fresh_path(spark, "workspace")
    chosen = {"customer": table(spark, sf_dir, "customer"), "nation": table(spark, sf_dir, "nation")}
    return checkpoints.restore(spark, root, checkpoints.save(spark, chosen, root, "local"), "local")["customer"]


@query("q_checkpoint_changed", """
  SELECT o.* REPLACE (CASE WHEN o_custkey = (SELECT max(o_custkey) FROM orders) THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
  FROM orders AS o""")
def checkpoint_changed(spark, sf_dir):
    """The orders with those of one customer corrected, from a checkpoint that continues the one before."""
    root = fresh_path(spark, "workspace")
    orders = table(spark, sf_dir, "orders")
    corrected = on_tables(spark, sf_dir, """
      SELECT * EXCEPT (o_totalprice), CASE WHEN o_custkey = (SELECT max(o_custkey) FROM {orders}) THEN o_totalprice + 1
        ELSE o_totalprice END AS o_totalprice FROM {orders}""").select(orders.columns)
    keys = {"orders": ["o_orderkey"]}
    first = checkpoints.save_changed(spark, {"orders": orders}, root, "local", keys=keys)
    last = checkpoints.save_changed(spark, {"orders": corrected}, root, "local", after=first, keys=keys)
    return checkpoints.restore(spark, root, last, "local")["orders"]


LINE_FACTS = ingest.PipelineSpec(
    id="line_facts", version="1.0.0", params=("multiplier",),
    steps=[
        ("options", "SELECT max(CAST(value_json AS DOUBLE)) FILTER (WHERE name = 'multiplier') AS multiplier FROM {run_params}"),
        ("documents", """SELECT asset_id AS document_key, original_name AS title, CAST(NULL AS STRING) AS markdown FROM {input_files}"""),
        ("evidence", """SELECT concat(asset_id, ':', o_orderkey) AS evidence_id, asset_id,
                          concat('{{"row":', o_orderkey + 2, '}}') AS locator_json, o_orderpriority AS quote
                        FROM {orders} JOIN {input_files} ON original_name = concat('customer ', o_custkey)"""),
        ("facts", """SELECT o_orderpriority AS item, o_totalprice * coalesce((SELECT multiplier FROM {options}), 1) AS value,
                       o_orderstatus AS category, concat(asset_id, ':', o_orderkey) AS evidence_id, asset_id
                     FROM {orders} JOIN {input_files} ON original_name = concat('customer ', o_custkey)"""),
    ],
    outputs={"documents": "documents", "evidence": "evidence", "facts": "facts"},
)


@query("q_declared_run", """
  SELECT o_orderpriority AS item, o_totalprice * 2 AS value, o_orderstatus AS category,
         sha256('customer ' || o_custkey) || ':' || o_orderkey AS evidence_id, sha256('customer ' || o_custkey) AS asset_id
  FROM orders JOIN customer ON o_custkey = c_custkey""")
def declared_run(spark, sf_dir):
    """A declared run with parameters, checks and a published artifact, asked for twice."""
    root = fresh_path(spark, "store")
    assets = on_tables(spark, sf_dir, """
      SELECT sha2(concat('customer ', c_custkey), 256) AS asset_id, concat('customer ', c_custkey) AS original_name FROM {customer}""")
    inputs = {"input_files": assets, "orders": table(spark, sf_dir, "orders")}
    ingest.run(spark, LINE_FACTS, inputs, {"multiplier": 2}, root, "local")
    again = ingest.run(spark, LINE_FACTS, inputs, {"multiplier": 2}, root, "local")
    if not again["reused"]:
        raise AssertionError("an equal run was not reused")
    return again["tables"]["facts"]


@query("q_page_read", """
  SELECT * FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS _row FROM orders)
  WHERE _row BETWEEN 40 AND 59""")
def page_read(spark, sf_dir):
    ordered = table(spark, sf_dir, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return store_result(ordered).page(offset=40, limit=20)


@query("q_result_rows", """
  SELECT event_id, user_id, row_number() OVER (ORDER BY user_id, ts, event_id) - 1 AS _row FROM events""")
def result_rows(spark, sf_dir):
    from factline.operators.numbering import number_all

    return number_all(table(spark, sf_dir, "events"), ["user_id", "ts", "event_id"]).select("event_id", "user_id", "_row")


@query("q_preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return spark.createDataFrame(results.preview(orders.orderBy("o_orderkey"))["preview"], orders.schema)


@query("q_unique_names", """
  SELECT o_orderkey AS k, o_custkey AS k_1, c_name AS v, o_totalprice AS v_3 FROM orders JOIN customer ON c_custkey = o_custkey""")
def unique_names(spark, sf_dir):
    """A result whose columns share names, stored and read back as a table."""
    joined = on_tables(spark, sf_dir, """
      SELECT o_orderkey AS k, o_custkey AS k, c_name AS v, o_totalprice AS v FROM {orders} JOIN {customer} ON c_custkey = o_custkey""")
    return store_result(joined).table()


@query("q_last_ops", "SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def last_ops(spark, sf_dir):
    log = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return oplog.last_operations(log, at="ts", tie="event_id")


NAMES = ["customer", "documents", "events", "lineitem", "orders", "pages"]


@query("q_catalog")
def catalog(spark, sf_dir):
    """Tables of a workspace with their columns, and the counted size of each."""
    from factline.plans.workspace import Workspace

    workspace = Workspace(spark, fresh_path(spark, "workspace"))
    for name in NAMES:
        workspace.add(name, table(spark, sf_dir, name), {"kind": "file"})
    counted = None
    for name in NAMES:
        one = workspace.tables[name].agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit(name))
        counted = one if counted is None else counted.unionByName(one)
    return workspace.catalog().join(counted, "name").select("name", F.size("columns").cast("bigint").alias("columns"), "kind", "rows")


_WIDTH = {"customer": 5, "documents": 5, "events": 6, "lineitem": 11, "orders": 6, "pages": 3}
ORACLES["q_catalog"] = " UNION ALL ".join(
    f"SELECT '{n}' AS name, CAST({_WIDTH[n]} AS BIGINT) AS columns, 'file' AS kind, count(*) AS rows FROM {n}" for n in NAMES)


@query("q_udf_increment", """
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) + 1 AS next_quantity FROM lineitem""")
def udf_increment(spark, sf_dir):
    spark.udf.register("increment", F.udf(lambda n: None if n is None else n + 1, "bigint", useArrow=True))
    return on_tables(spark, sf_dir, """
      SELECT l_orderkey, l_linenumber, increment(CAST(l_quantity AS BIGINT)) AS next_quantity FROM {lineitem}""")


# A region's suppliers deliver to orders; each order of a customer is made with the one before it.
@query("q_lineage", """
  WITH ranked AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders),
  met AS (SELECT DISTINCT n_regionkey, o_custkey, r FROM lineitem JOIN ranked ON l_orderkey = o_orderkey
          JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
  SELECT 'region:' || n_regionkey AS start, 'order:' || o.o_orderkey AS node, 3 + min(o.r - met.r) AS distance
  FROM met JOIN ranked AS o ON o.o_custkey = met.o_custkey AND o.r >= met.r GROUP BY ALL
  UNION ALL SELECT 'region:' || n_regionkey, 'nation:' || n_nationkey, 1 FROM nation
  UNION ALL SELECT 'region:' || n_regionkey, 'supplier:' || s_suppkey, 2 FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def lineage_closure(spark, sf_dir):
    """Everything that rests on a region, over edges recorded by four operations."""
    folder = fresh_path(spark, "edges")
    for operation, sql in {
        "nations": "SELECT concat('region:', n_regionkey) AS source, concat('nation:', n_nationkey) AS target FROM {nation}",
        "suppliers": "SELECT concat('nation:', s_nationkey) AS source, concat('supplier:', s_suppkey) AS target FROM {supplier}",
        "lines": "SELECT concat('supplier:', l_suppkey) AS source, concat('order:', l_orderkey) AS target FROM {lineitem}",
        "orders": """SELECT concat('order:', lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)) AS source,
                       concat('order:', o_orderkey) AS target FROM {orders}""",
    }.items():
        lineage.record(on_tables(spark, sf_dir, sql), folder, operation)
    starts = on_tables(spark, sf_dir, "SELECT concat('region:', r_regionkey) AS node FROM {region}")
    return lineage.reach(lineage.recorded(spark, folder), starts)

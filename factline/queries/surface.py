"""SQL a user may run as it stands: the same text on Spark and in the check."""

from __future__ import annotations

from factline.plans.workspace import Workspace
from factline.queries.registry import query, table
from factline.storage import fresh_path

REVENUE = "CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(1 - l_discount AS DECIMAL(4, 2))) AS DOUBLE)"

STATEMENTS = {
    "q_group_sum": """
      SELECT l_returnflag, l_linestatus, count(*) AS lines, sum(l_quantity) AS total FROM {lineitem} GROUP BY l_returnflag, l_linestatus""",
    "q_sum_total": "SELECT count(*) AS lines, sum(l_quantity) AS total FROM {lineitem}",
    "q_sql_joins": f"""
      SELECT n.n_name, o.o_orderpriority, count(*) AS lines, count(DISTINCT o.o_orderkey) AS orders, {REVENUE} AS revenue
      FROM {{lineitem}} l
      JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey AND l.l_shipdate >= o.o_orderdate
      JOIN {{customer}} c ON o.o_custkey = c.c_custkey
      LEFT JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
      WHERE EXISTS (SELECT 1 FROM {{part}} p WHERE p.p_partkey = l.l_partkey AND p.p_size > 10)
        AND NOT EXISTS (SELECT 1 FROM {{supplier}} s WHERE s.s_suppkey = l.l_suppkey AND s.s_acctbal < 0)
      GROUP BY n.n_name, o.o_orderpriority""",
    "q_sql_full_join": """
      SELECT coalesce(a.k, b.k) AS k, a.n AS orders, b.n AS events
      FROM (SELECT o_custkey AS k, count(*) AS n FROM {orders} GROUP BY o_custkey) a
      FULL JOIN (SELECT user_id AS k, count(*) AS n FROM {events} GROUP BY user_id) b ON a.k = b.k""",
    "q_sql_windows": """
      SELECT o_orderpriority, y, m, orders, sum(orders) OVER (PARTITION BY o_orderpriority ORDER BY y, m) AS so_far,
             orders - lag(orders) OVER (PARTITION BY o_orderpriority ORDER BY y, m) AS change,
             rank() OVER (PARTITION BY o_orderpriority ORDER BY orders DESC) AS place
      FROM (SELECT o_orderpriority, year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS orders
            FROM {orders} GROUP BY o_orderpriority, year(o_orderdate), month(o_orderdate)) t""",
    "q_sql_rollup": """
      SELECT l_returnflag, l_linestatus, count(*) AS lines, sum(l_quantity) AS total
      FROM {lineitem} GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "q_sql_setops": """
      (SELECT o_custkey AS k FROM {orders} INTERSECT SELECT user_id FROM {events})
      UNION ALL (SELECT c_custkey FROM {customer} EXCEPT SELECT o_custkey FROM {orders})""",
    "q_sql_topk": """
      SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
      FROM {orders} GROUP BY o_custkey ORDER BY total DESC, o_custkey LIMIT 25""",
}


def in_workspace(spark, sf_dir, statement: str, bound: list | None = None):
    """The stored result of a statement that a workspace runs over the tables it names."""
    work = Workspace(spark, fresh_path(spark, "workspace"))
    for t in ("lineitem", "orders", "customer", "nation", "part", "supplier", "events"):
        if t in statement:
            work.add(t, table(spark, sf_dir, t))
    return work.results[work.sql(statement, bound)].table()


def _register(name: str, statement: str) -> None:
    plain = statement
    for t in ("lineitem", "orders", "customer", "nation", "part", "supplier", "events"):
        plain = plain.replace("{" + t + "}", t)
    query(name, plain)(lambda spark, sf_dir: in_workspace(spark, sf_dir, plain))


for _name, _statement in STATEMENTS.items():
    _register(_name, _statement)


@query("q_sql_bound_params", """
  SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
  WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_totalprice > 1000.5""")
def bound_params(spark, sf_dir):
    return in_workspace(spark, sf_dir, """
      SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
      WHERE o_orderpriority = ? AND o_orderdate >= CAST(? AS TIMESTAMP_NTZ) AND o_totalprice > ?""",
                        ["1-URGENT", "1997-01-01", 1000.5])

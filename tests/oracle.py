"""Run registered queries and their checking SQL side by side: python tests/oracle.py SF_DIR [name ...]."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def compare(spark, db, sf_dir, run, sql):
    df = run(spark, sf_dir)
    got = df.collect()
    if sql is None:
        return f"rows only: {len(got)}" if got else "EMPTY"
    cursor = db.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(columns)}"
    if not expected:
        return "EMPTY"
    a, b = normal(df.columns, [tuple(r) for r in got]), normal(columns, expected)
    if a == b:
        return f"ok {len(a)}"
    extra, lost = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"DIFFERENT spark {len(a)} sql {len(b)}\n   spark only {str(extra)[:700]}\n   sql only   {str(lost)[:700]}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = sys.argv[1], sys.argv[2:]
    db, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            said = compare(spark, db, sf_dir, run, sqls.get(name))
        except Exception as error:
            said = f"FAILED {type(error).__name__}: {str(error)[:900]}"
        bad += not said.startswith(("ok", "rows only"))
        print(f"{name:28s} {time.time() - start:6.2f}s {said}", flush=True)
    print("bad:", bad)

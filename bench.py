"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from factline.queries import QUERIES  # noqa: E402

HEADLINE = [
    "q_table_observations", "q_fact_evidence_join", "q_item_totals", "q_text_observations", "q_publish_documents",
    "q_lateral_facts", "q_reconcile", "q_unmatched", "q_supplement_fill", "q_dup_keys", "q_null_profile",
    "q_coverage_change", "q_conflicts", "q_content_digest", "q_hash_verify", "q_locator_validation", "q_manifest_check",
    "q_redact", "q_chunks_assemble", "q_chunk_completeness", "q_marker_status", "q_model_sanitize", "q_recipe_index",
    "q_artifact_roundtrip", "q_page_read", "q_udf_increment", "q_group_sum", "q_sql_joins",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM, code generation and the Python workers before anything is timed.
    spark.read.parquet(f"{sf_dir}/region.parquet").groupBy("r_name").count().collect()
    times = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

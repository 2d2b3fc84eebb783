"""Records, evidence and facts from tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.operators import checks, compare, delimited, observations, publish, replies
from factline.plans import documents
from factline.queries.registry import on_tables, query, table
from factline.sources import files
from factline.storage import fresh_path, keep

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"]

RECORDS = f"""
  SELECT 'supplier-' || l_suppkey AS asset_id, 'part-' || l_partkey AS item, l_quantity AS value,
         l_returnflag AS category,
         CAST(1 + row_number() OVER (PARTITION BY l_suppkey ORDER BY {", ".join(ORDER)}) AS VARCHAR) AS key
  FROM lineitem"""
QUOTE = """'{"item":"' || item || '","value":' || CAST(value AS VARCHAR) || ',"category":"' || category || '"}'"""


def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    named = lines.select(
        F.concat(F.lit("supplier-"), F.col("l_suppkey")).alias("source"),
        F.concat(F.lit("part-"), F.col("l_partkey")).alias("part"), *ORDER)
    return observations.table_records(named, "source", "part", "l_quantity", "l_returnflag", ORDER)


@query("q_table_observations", f"""
  SELECT asset_id, key, '{{"row":' || key || '}}' AS locator_json, {QUOTE} AS quote, item, value, category
  FROM ({RECORDS})""")
def table_observations(spark, sf_dir):
    return line_records(spark, sf_dir)


@query("q_publish_evidence", f"""
  SELECT asset_id || ':' || key AS evidence_id, asset_id, '{{"row":' || key || '}}' AS locator_json, {QUOTE} AS quote
  FROM ({RECORDS})""")
def publish_evidence(spark, sf_dir):
    return publish.evidence_of(line_records(spark, sf_dir))


@query("q_publish_facts", f"""
  SELECT item, value, category, asset_id || ':' || key AS evidence_id, asset_id FROM ({RECORDS})""")
def publish_facts(spark, sf_dir):
    return publish.facts_of(line_records(spark, sf_dir))


@query("q_fact_evidence_join", f"""
  SELECT item, value, category, asset_id || ':' || key AS evidence_id, asset_id,
         '{{"row":' || key || '}}' AS locator_json, {QUOTE} AS quote, FALSE AS evidence_gap
  FROM ({RECORDS})""")
def fact_evidence_join(spark, sf_dir):
    records = keep(line_records(spark, sf_dir), "records")
    return compare.with_evidence(publish.facts_of(records), publish.evidence_of(records))


@query("q_multiplier", f"""
  SELECT item, value * 2 AS value, category, asset_id || ':' || key AS evidence_id, asset_id FROM ({RECORDS})""")
def multiplier(spark, sf_dir):
    return publish.facts_of(observations.scale(line_records(spark, sf_dir), 2))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to published tables, checks, evidence join and totals per item."""
    records = keep(line_records(spark, sf_dir), "records")
    facts, evidence = publish.facts_of(records), publish.evidence_of(records)
    assets = table(spark, sf_dir, "supplier").select(F.concat(F.lit("supplier-"), F.col("s_suppkey")).alias("asset_id"))
    checks.require_none(checks.check_evidence(evidence, assets), "evidence")
    cited = compare.with_evidence(facts, evidence)
    return cited.groupBy("item").agg(
        F.count(F.lit(1)).alias("facts"), F.sum("value").alias("total"), F.count_if("evidence_gap").alias("gaps"))


@query("q_item_totals", """
  SELECT 'part-' || l_partkey AS item, count(*) AS facts, sum(l_quantity) AS total, CAST(0 AS BIGINT) AS gaps
  FROM lineitem GROUP BY l_partkey""")
def item_totals(spark, sf_dir):
    return totals(spark, sf_dir)


@query("q_publish_documents", r"""
  SELECT 'conversation-' || conv_id AS document_key, 'conversation ' || conv_id AS title,
         string_agg(text, chr(10) || chr(10) ORDER BY turn) AS markdown
  FROM conversations GROUP BY conv_id""")
def publish_documents(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conversation-"), F.col("conv_id")).alias("asset_id"), F.col("turn").alias("page"), "text")
    joined = observations.join_pages(pages).withColumn("original_name", F.replace("asset_id", F.lit("-"), F.lit(" ")))
    return publish.documents_of(joined)


@query("q_page_evidence", """
  SELECT 'conversation-' || conv_id || ':' || (turn + 1) AS evidence_id, 'conversation-' || conv_id AS asset_id,
         '{"page":' || (turn + 1) || '}' AS locator_json, text AS quote
  FROM conversations""")
def page_evidence(spark, sf_dir):
    pages = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conversation-"), F.col("conv_id")).alias("asset_id"), (F.col("turn") + 1).alias("page"), "text")
    return publish.evidence_of(observations.page_evidence(pages))


# Documents: prose, of which nothing follows the grammar. Lines: a heading, an observation, a remark.
# Fixed value: the observation grammar, in both patterns of the SQL.
@query("q_text_observations", r"""
  WITH pages AS (
    SELECT 'document-' || doc_id AS asset_id, 1 AS page, text FROM documents
    UNION ALL
    SELECT 'order-' || l_orderkey, l_linenumber, 'Lines of order ' || l_orderkey || chr(10) || 'part ' || l_partkey
           || ' : ' || CAST(l_quantity AS VARCHAR) || ', ' || l_returnflag || chr(10) || 'no further remarks'
    FROM lineitem),
  split AS (
    SELECT asset_id, page, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS pos
    FROM (SELECT *, regexp_split_to_array(text, '\r\n|[\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]') AS parts FROM pages)),
  matched AS (
    SELECT *, regexp_extract(line, '^\s*([\p{L}\p{N}_ -]+)\s*[,：:]\s*(-?\d+(?:\.\d+)?)\s*(?:,\s*(.*))?$',
                             ['item', 'number', 'category']) AS m FROM split
    WHERE regexp_matches(line, '^\s*([\p{L}\p{N}_ -]+)\s*[,：:]\s*(-?\d+(?:\.\d+)?)\s*(?:,\s*(.*))?$'))
  SELECT asset_id, CAST(page AS VARCHAR) AS key, pos, trim(m['item']) AS item, CAST(m['number'] AS DOUBLE) AS value,
         nullif(m['category'], '') AS category
  FROM matched""")
def text_observations(spark, sf_dir):
    lines = on_tables(spark, sf_dir, r"""
      SELECT concat('document-', doc_id) AS asset_id, 1 AS page, text FROM {documents}
      UNION ALL
      SELECT concat('order-', l_orderkey), l_linenumber,
             concat('Lines of order ', l_orderkey, '\n', 'part ', l_partkey, ' : ', l_quantity, ', ', l_returnflag,
                    '\n', 'no further remarks')
      FROM {lineitem}""")
    return observations.page_observations(lines)


PAYLOAD = """
  concat('{"title":"event","markdown":"","evidence":[',
    CASE WHEN event_type = 'error' THEN '' ELSE concat(
      '{"key":"1","locator":{"row":', event_id + 2, '},"quote":"', event_type, '"}',
      CASE WHEN event_type = 'purchase' THEN concat(',{"key":"2","locator":{},"quote":"user ', user_id, '"}') ELSE '' END)
    END, '],"observations":[',
    CASE WHEN event_type = 'error' THEN '' ELSE concat(
      '{"item":"user ', user_id, '","value":', value, ',"category":null,"key":"1"}',
      CASE WHEN event_type = 'purchase' THEN concat(',{"item":"', event_type, '","value":null,"category":"x","key":"2"}') ELSE '' END)
    END, ']}')"""


def payloads(spark, sf_dir):
    return on_tables(spark, sf_dir, f"SELECT event_id AS asset_id, PAYLOAD AS payload FROM {{events}}".replace(
        "PAYLOAD", PAYLOAD.replace("{", "{{").replace("}", "}}")))


@query("q_lateral_evidence", f"""
  WITH p AS (SELECT CAST(event_id AS VARCHAR) AS asset_id, json_extract({PAYLOAD}, '$.evidence[*]') AS parts FROM events),
  e AS (SELECT asset_id, unnest(parts) AS j, generate_subscripts(parts, 1) - 1 AS pos FROM p)
  SELECT asset_id || ':' || json_extract_string(j, '$.key') AS evidence_id, asset_id,
         CAST(json_extract(j, '$.locator') AS VARCHAR) AS locator_json, json_extract_string(j, '$.quote') AS quote, pos
  FROM e""")
def lateral_evidence(spark, sf_dir):
    return publish.payload_evidence(payloads(spark, sf_dir))


@query("q_lateral_facts", f"""
  WITH p AS (SELECT CAST(event_id AS VARCHAR) AS asset_id, json_extract({PAYLOAD}, '$.observations[*]') AS parts FROM events),
  e AS (SELECT asset_id, unnest(parts) AS j, generate_subscripts(parts, 1) - 1 AS pos FROM p)
  SELECT json_extract_string(j, '$.item') AS item, CAST(json_extract_string(j, '$.value') AS DOUBLE) AS value,
         json_extract_string(j, '$.category') AS category,
         asset_id || ':' || json_extract_string(j, '$.key') AS evidence_id, asset_id, pos
  FROM e""")
def lateral_facts(spark, sf_dir):
    return publish.payload_facts(payloads(spark, sf_dir))


def event_params(spark, sf_dir):
    return on_tables(spark, sf_dir, """
      SELECT event_type AS name, CAST(count(*) AS STRING) AS value_json FROM {events} GROUP BY event_type""")


FOLDED = """
  SELECT '{' || coalesce(string_agg('"' || event_type || '":"' || n || '"', ',' ORDER BY event_type), '') || '}' AS params_json
  FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)"""


@query("q_params_fold", FOLDED)
def params_fold(spark, sf_dir):
    return publish.fold_params(event_params(spark, sf_dir))


@query("q_params_scalar", f"SELECT event_id, value, ({FOLDED}) AS params_json FROM events")
def params_scalar(spark, sf_dir):
    folded = publish.fold_params(event_params(spark, sf_dir))
    return spark.sql("SELECT event_id, value, (SELECT params_json FROM {folded}) AS params_json FROM {events}",
                     folded=folded, events=table(spark, sf_dir, "events"))


# Items hold quotes, a comma and a line end, so records go over lines and, where Spark cuts files, over blocks.
CSV_ITEM = """concat('part "', l_partkey, '",', chr(10), l_returnflag)"""
CSV_ROWS = f"""
  SELECT 'lines-' || l_linenumber AS asset_id, {CSV_ITEM} AS item, l_quantity AS value, nullif(l_returnflag, 'N') AS category,
         CAST(1 + row_number() OVER (PARTITION BY l_linenumber ORDER BY {", ".join(ORDER)}) AS VARCHAR) AS key
  FROM lineitem"""
CSV_QUOTE = r"""concat('{"item": "', replace(replace(item, '"', '\"'), chr(10), '\n'), '", "value": "', CAST(value AS VARCHAR),
         '", "category": "', coalesce(category, ''), '"}')"""


def csv_rows(spark, sf_dir, folder: str, item: str) -> DataFrame:
    return on_tables(spark, sf_dir, f"""
      SELECT {item} AS item, l_quantity AS value, nullif(l_returnflag, 'N') AS category, {folder} AS folder, {", ".join(ORDER)}
      FROM {{lineitem}}""")


def written_csv(spark, sf_dir, folder: str, item: str) -> str:
    """Lines as one CSV file for each value of a column, in order."""
    path = fresh_path(spark, "csv-documents")
    (csv_rows(spark, sf_dir, folder, item).repartition("folder").sortWithinPartitions("folder", *ORDER)
     .select("item", "value", "category", "folder").write.partitionBy("folder").option("header", "true").option("escape", '"').csv(path))
    return path


@query("q_csv_documents", f"""
  SELECT asset_id, key, '{{"row":' || key || '}}' AS locator_json, {CSV_QUOTE} AS quote, item, value, category FROM ({CSV_ROWS})""")
def csv_documents(spark, sf_dir):
    """CSV files cut over tasks wherever Spark cuts them."""
    path = written_csv(spark, sf_dir, "l_linenumber", CSV_ITEM)
    assets = files.scan_assets(spark, path, "*.csv").select(
        "path", F.concat(F.lit("lines-"), F.regexp_extract("path", "folder=([^/]*)/", 1)).alias("asset_id"))
    return delimited.csv_records(files.csv_lines(spark, path, "*.csv"), assets)


INGESTED = f"""
  SELECT 'supplier-' || l_suppkey AS asset_id, 'part-' || l_partkey AS item, l_quantity AS value, nullif(l_returnflag, 'N') AS category,
         CAST(1 + row_number() OVER (PARTITION BY l_suppkey ORDER BY {", ".join(ORDER)}) AS VARCHAR) AS key
  FROM lineitem"""


def ingested(spark, sf_dir) -> dict:
    """CSV files and paged conversations through the whole ingest; conversations hold no observations."""
    path = fresh_path(spark, "csv-documents")
    files.write_csv_each(csv_rows(spark, sf_dir, "l_suppkey", "concat('part-', l_partkey)"), "folder", ORDER, ["item", "value", "category"], path)
    supplier = F.regexp_extract("path", "folder=([^/.]*)", 1)
    written = files.scan_assets(spark, path, "*.csv", content=True).select(
        F.concat(F.lit("supplier-"), supplier).alias("asset_id"), "media_type",
        F.concat(F.lit("supplier "), supplier, F.lit(".csv")).alias("original_name"), "content")
    paged = on_tables(spark, sf_dir, """
      SELECT DISTINCT concat('conversation-', conv_id) AS asset_id, 'application/pdf' AS media_type,
             concat('conversation ', conv_id) AS original_name, CAST('' AS BINARY) AS content FROM {conversations}""")
    pages = on_tables(spark, sf_dir, """
      SELECT concat('conversation-', conv_id) AS asset_id, turn + 1 AS page, text FROM {conversations}""")
    return documents.ingest_documents(spark, written.unionByName(paged), fresh_path(spark, "store"), "local", pages, multiplier=2)["tables"]


@query("q_ingest_documents", f"""
  SELECT item, value * 2 AS value, category, asset_id || ':' || key AS evidence_id, asset_id FROM ({INGESTED})""")
def ingest_documents(spark, sf_dir):
    return ingested(spark, sf_dir)["facts"]


@query("q_ingest_evidence", f"""
  SELECT asset_id || ':' || key AS evidence_id, asset_id, '{{"row":' || key || '}}' AS locator_json,
         concat('{{"item": "', item, '", "value": "', CAST(value AS VARCHAR), '", "category": "', coalesce(category, ''), '"}}') AS quote
  FROM ({INGESTED})
  UNION ALL
  SELECT 'conversation-' || conv_id || ':' || (turn + 1), 'conversation-' || conv_id, '{{"page":' || (turn + 1) || '}}', text FROM conversations""")
def ingest_evidence(spark, sf_dir):
    return ingested(spark, sf_dir)["evidence"]


@query("q_ingest_texts", f"""
  SELECT asset_id AS document_key, replace(asset_id, '-', ' ') || '.csv' AS title, 'item,value,category' || chr(10) || string_agg(
           item || ',' || CAST(value AS VARCHAR) || ',' || coalesce(category, '') || chr(10), '' ORDER BY CAST(key AS BIGINT)) AS markdown
  FROM ({INGESTED}) GROUP BY asset_id
  UNION ALL
  SELECT 'conversation-' || conv_id, 'conversation ' || conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn)
  FROM conversations GROUP BY conv_id""")
def ingest_texts(spark, sf_dir):
    return ingested(spark, sf_dir)["documents"]


@query("q_csv_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_table(spark, sf_dir):
    path = fresh_path(spark, "csv")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    rows.write.option("header", "true").csv(path)
    return files.load_table(spark, path, "csv", rows.schema)


@query("q_jsonl_table", "SELECT event_id, user_id, event_type, value, props FROM events")
def jsonl_table(spark, sf_dir):
    path = fresh_path(spark, "jsonl")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    files.write_jsonl(rows, path)
    return files.load_table(spark, path, "json", rows.schema)


@query("q_parquet_table", "SELECT * FROM orders")
def parquet_table(spark, sf_dir):
    return files.load_table(spark, f"{sf_dir}/orders.parquet")


REQUEST_PROMPT = "Give the observations of this document as JSON."


@query("q_model_request", f"""
  SELECT doc_id, to_json(struct_pack(
      model := 'reader', messages := [struct_pack(role := 'user', content := [struct_pack(type := 'text',
        text := '{REQUEST_PROMPT}' || chr(10) || 'Keep the language.' || chr(10) || 'Document:' || chr(10) || text)])],
      stream := FALSE, temperature := 0, max_tokens := 2048))::VARCHAR AS request
  FROM documents""")
def model_request(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("markdown"))
    return observations.model_requests(documents, REQUEST_PROMPT, "reader", "Keep the language.").select("doc_id", "request")


REPLY = """
  CASE lang
    WHEN 'en' THEN concat('```json{nl}{"observations":[{"item":"words","value":', n_chars, ',"category":null,"quote":"q","page":1,"bbox":[0,0,0.5,1]},',
                          '{"item":"', source, '","value":null,"category":"c","quote":"second","page":0,"bbox":[0.5,0,0.25,1]}]}{nl}```')
    WHEN 'fr' THEN concat('  {"observations":[{"item":"words","value":"', n_chars, '","quote":7,"page":2.0,"bbox":[0,0,2,1]}]}')
    WHEN 'de' THEN CASE WHEN n_chars > 1000 THEN concat('{"observations":[{"item":"words","value":', n_chars, '}]}') ELSE '{"observations":[]}' END
    ELSE CASE WHEN n_chars > 1000 THEN 'not JSON' ELSE '{"items":[]}' END
  END"""
MEDIA = "CASE WHEN n_chars > 2000 THEN 'application/pdf' WHEN n_chars > 500 THEN 'image/png' ELSE 'text/csv' END"


def model_replies(spark, sf_dir):
    reply = REPLY.replace("{nl}", "\\n").replace("{", "{{").replace("}", "}}")
    return on_tables(spark, sf_dir, f"""
      SELECT concat('document-', doc_id) AS asset_id, {MEDIA} AS media_type, {reply} AS reply FROM {{documents}}""")


@query("q_model_sanitize", f"""
  WITH d AS (SELECT 'document-' || doc_id AS asset_id, lang, source, n_chars, {MEDIA} AS media_type FROM documents),
  r AS (
    SELECT asset_id, media_type, '1' AS key, 'q' AS quote, 'words' AS item, CAST(n_chars AS DOUBLE) AS value, NULL AS category,
           '{{"page":1}}' AS page, '{{"bbox":[0,0,0.5,1]}}' AS box FROM d WHERE lang = 'en'
    UNION ALL SELECT asset_id, media_type, '2', 'second', source, NULL, 'c', '{{}}', '{{}}' FROM d WHERE lang = 'en'
    UNION ALL SELECT asset_id, media_type, '1', '7', 'words', CAST(n_chars AS DOUBLE), NULL, '{{}}', '{{}}' FROM d WHERE lang = 'fr')
  SELECT asset_id, key,
         CASE WHEN media_type = 'application/pdf' THEN page WHEN media_type = 'image/png' THEN box ELSE '{{}}' END AS locator_json,
         quote, item, value, category
  FROM r""")
def model_sanitize(spark, sf_dir):
    return observations.sanitize_replies(model_replies(spark, sf_dir))[0]


@query("q_model_rejected", """
  SELECT 'document-' || doc_id AS asset_id,
         CASE WHEN lang = 'de' THEN 'observation misses a field' WHEN n_chars > 1000 THEN 'reply is not JSON'
              ELSE 'reply has no observations' END AS problem
  FROM documents WHERE lang = 'es' OR (lang = 'de' AND n_chars > 1000)""")
def model_rejected(spark, sf_dir):
    return observations.sanitize_replies(model_replies(spark, sf_dir))[1]


def word_count(request: str) -> str:
    """A stand-in for a model: counts what stands after the prompt."""
    import json

    return str(len(json.loads(request)["messages"][0]["content"][0]["text"].split("Document:\n", 1)[1]))


@query("q_reply_memo", """
  SELECT doc_id, CAST(length(text) AS VARCHAR) AS reply,
         CASE WHEN text IN (SELECT text FROM documents WHERE lang = 'en') THEN 'first' ELSE 'second' END AS run
  FROM documents""")
def reply_memo(spark, sf_dir):
    """Two runs over the same store: the second one asks only for what the first one did not."""
    asked = observations.model_requests(
        table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("text").alias("markdown")), REQUEST_PROMPT, "reader").drop("markdown")
    folder = fresh_path(spark, "memo")
    replies.with_replies(asked.filter("lang = 'en'"), word_count, folder, "first", calls_per_task=500)
    replied = replies.with_replies(asked, word_count, folder, "second", calls_per_task=500)
    runs = replies.stored(spark, replies.store_of(folder, word_count)).select("request_hash", "run")
    return replied.join(runs, F.sha2("request", 256) == F.col("request_hash")).select("doc_id", "reply", "run")


@query("q_model_extract", """
  SELECT 'document-' || doc_id AS asset_id, '1' AS key, '{}' AS locator_json, lang AS quote, 'characters' AS item,
         CAST(length(text) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS category
  FROM documents""")
def model_extract(spark, sf_dir):
    """The batch call with a stand-in for the model that counts characters."""

    def count_characters(request: str) -> str:
        import json

        body = json.loads(request)["messages"][0]["content"][0]["text"]
        head, markdown = body.split("Document:\n", 1)
        return json.dumps({"observations": [{"item": "characters", "value": len(markdown), "quote": head.split("\n")[1]}]})

    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("document-"), F.col("doc_id")).alias("asset_id"), F.lit("text/plain").alias("media_type"),
        F.col("text").alias("markdown"), "lang")
    requests = observations.model_requests(documents, REQUEST_PROMPT, "reader", "LANG")
    requests = requests.withColumn("request", F.replace("request", F.lit("\\nLANG\\n"), F.concat(F.lit("\\n"), F.col("lang"), F.lit("\\n"))))
    replied = keep(observations.call_model(requests.drop("markdown", "lang"), count_characters), "replies")
    return observations.sanitize_replies(replied)[0]

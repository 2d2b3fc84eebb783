"""Knowledge pages built from conversations: a conversation is a document, a turn a chunk."""

from __future__ import annotations

from pyspark.sql import functions as F

from factline.operators import chunks
from factline.queries.registry import on_tables, query
from factline.storage import fresh_path
from factline.streaming.pages import follow_pages, land_in, latest

# Three turns per page. Documents of 6 turns repeat page 1 as page 2; documents of 4 and 5 do
# not declare a total, and those of 5 end with an empty page; documents of 7 declare one turn
# too many, and those of 8 change their total on page 2.
LANDED = """
  SELECT concat('conversation-', c.conv_id) AS knowledge_id, CAST(floor(c.turn / 3) AS BIGINT) + 1 AS page,
         c.turn % 3 AS pos,
         concat('c', c.conv_id, '-', CASE WHEN n.turns = 6 AND c.turn >= 3 THEN c.turn - 3 ELSE c.turn END) AS chunk_id,
         c.turn AS chunk_index, c.text AS content, c.role AS role, n.turns AS turns, c.conv_id AS conv_id,
         CASE WHEN n.turns IN (4, 5) THEN NULL WHEN n.turns = 7 THEN 8 WHEN n.turns = 8 AND c.turn >= 3 THEN 9
              ELSE n.turns END AS total
  FROM {conversations} c JOIN (SELECT conv_id, count(*) AS turns FROM {conversations} GROUP BY conv_id) n
    ON c.conv_id = n.conv_id"""
LANDED_SQL = LANDED.replace("{conversations}", "conversations")


def envelopes(spark, sf_dir):
    """Answer pages: at most three chunks each."""
    landed = on_tables(spark, sf_dir, LANDED)
    chunk = F.struct(F.col("pos"), F.col("chunk_id").alias("id"), F.col("knowledge_id"), F.col("chunk_index"), F.col("content"))
    pages = landed.groupBy("knowledge_id", "page").agg(
        F.max("total").alias("total"), F.array_sort(F.collect_list(chunk)).alias("data"))
    pages = pages.select("knowledge_id", "page", F.lit(True).alias("success"), "total", F.transform(
        "data", lambda c: F.struct(c["id"].alias("id"), c["knowledge_id"].alias("knowledge_id"),
                                   c["chunk_index"].alias("chunk_index"), c["content"].alias("content"))).alias("data"))
    closing = landed.filter("turns = 5 AND chunk_index = 4").select(
        "knowledge_id", F.lit(3).cast("bigint").alias("page"), F.lit(True).alias("success"),
        F.lit(None).cast("bigint").alias("total"),
        F.array().cast("array<struct<id:string,knowledge_id:string,chunk_index:bigint,content:string>>").alias("data"))
    return pages.unionByName(closing)


# The reading order of pages, replayed with windows.
REPLAY = f"""
  WITH landed AS ({LANDED_SQL}),
  pages AS (
    SELECT knowledge_id, page, count(*) AS n, max(total) AS declared FROM landed GROUP BY 1, 2
    UNION ALL SELECT DISTINCT knowledge_id, 3, 0, NULL FROM landed WHERE turns = 5),
  firsts AS (SELECT knowledge_id, chunk_id, min(page) AS page FROM landed GROUP BY 1, 2),
  steps AS (
    SELECT p.*, (SELECT count(*) FROM firsts f WHERE f.knowledge_id = p.knowledge_id AND f.page = p.page) AS added,
           sum(n) OVER w AS seen, last_value(declared IGNORE NULLS) OVER w AS total
    FROM pages p WINDOW w AS (PARTITION BY knowledge_id ORDER BY page)),
  more AS (
    SELECT *, sum(added) OVER w AS distinct_chunks,
           CASE WHEN n = 0 OR seen >= total THEN 'ended' WHEN added = 0 THEN 'repeated' END AS stop
    FROM steps WINDOW w AS (PARTITION BY knowledge_id ORDER BY page)),
  ends AS (
    SELECT *, row_number() OVER (PARTITION BY knowledge_id ORDER BY stop IS NULL, CASE WHEN stop IS NULL THEN -page ELSE page END) AS r
    FROM more QUALIFY r = 1)"""


COMPLETENESS = REPLAY + f"""
  , c AS (
    SELECT e.knowledge_id, e.page AS fetched_pages, e.seen, e.distinct_chunks, e.total, e.stop,
           (SELECT count(DISTINCT declared) > 1 FROM pages p WHERE p.knowledge_id = e.knowledge_id AND p.page <= e.page) AS total_changed,
           coalesce(e.stop = 'ended' AND CASE WHEN e.total IS NULL THEN e.n = 0 ELSE e.distinct_chunks = e.total END, FALSE) AS all_read
    FROM ends e)
  SELECT knowledge_id, fetched_pages, CAST(seen AS BIGINT) AS seen, CAST(distinct_chunks AS BIGINT) AS distinct_chunks,
         total, total_changed, coalesce(stop = 'repeated', FALSE) AS repeated,
         all_read AND NOT total_changed AND NOT coalesce(stop = 'repeated', FALSE) AS complete,
         concat_ws(' ', CASE WHEN total_changed THEN '{chunks.TOTAL_CHANGED}' END,
                   CASE WHEN stop = 'repeated' THEN '{chunks.REPEATED}' END,
                   CASE WHEN NOT all_read THEN '{chunks.PARTIAL}' END) AS warnings
  FROM c"""


@query("q_chunk_completeness", COMPLETENESS)
def chunk_completeness(spark, sf_dir):
    return chunks.completeness(envelopes(spark, sf_dir))


@query("q_pages_arriving", COMPLETENESS)
def pages_arriving(spark, sf_dir):
    """The same pages landed out of order in files, some of them twice, and read as a stream of several batches."""
    landed, progress, out = (fresh_path(spark, name) for name in ("landed-pages", "page-progress", "page-status"))
    pages = envelopes(spark, sf_dir)
    again = pages.filter(F.crc32(F.concat("knowledge_id", F.col("page").cast("string")).cast("binary")) % 5 == 0)
    dealt = F.pmod(F.xxhash64("knowledge_id", -F.col("page"), "turn"), F.lit(8)).cast("int")
    both = pages.withColumn("turn", F.lit(0)).unionByName(again.withColumn("turn", F.lit(1)))
    both.repartition(8, dealt).drop("turn").write.json(landed)
    follow_pages(spark, landed, progress, land_in(out), files_per_batch=3)
    return latest(spark, out).drop("stopped", "given_up")


ASSEMBLED = REPLAY + """
  , firstrow AS (
    SELECT l.*, row_number() OVER (PARTITION BY knowledge_id, chunk_id ORDER BY page, pos) AS r FROM landed l QUALIFY r = 1)
  SELECT f.chunk_id, f.knowledge_id, f.chunk_index, f.content, f.page, f.pos
  FROM firstrow f JOIN ends e ON f.knowledge_id = e.knowledge_id AND f.page <= e.page"""


@query("q_chunks_assemble", ASSEMBLED)
def chunks_assemble(spark, sf_dir):
    return chunks.assemble(envelopes(spark, sf_dir))


def requested(spark, sf_dir):
    return on_tables(spark, sf_dir, """
      SELECT concat('conversation-', conv_id) AS knowledge_id, concat('c', conv_id, '-', turn + 1) AS chunk_id
      FROM {conversations} WHERE role = 'user'""")


@query("q_missing_chunks", f"""
  SELECT 'conversation-' || conv_id AS knowledge_id, 'c' || conv_id || '-' || (turn + 1) AS chunk_id
  FROM conversations WHERE role = 'user'
  EXCEPT SELECT knowledge_id, chunk_id FROM ({LANDED_SQL})""")
def missing_chunks(spark, sf_dir):
    return chunks.missing(envelopes(spark, sf_dir), requested(spark, sf_dir))


@query("q_chunks_requested", f"""
  WITH landed AS ({LANDED_SQL}),
  firstrow AS (
    SELECT l.*, row_number() OVER (PARTITION BY knowledge_id, chunk_id ORDER BY page, pos) AS r FROM landed l QUALIFY r = 1)
  SELECT chunk_id, knowledge_id, chunk_index, content, page, pos FROM firstrow WHERE chunk_index = 0""")
def chunks_requested(spark, sf_dir):
    first_turns = on_tables(spark, sf_dir, """
      SELECT concat('conversation-', conv_id) AS knowledge_id, concat('c', conv_id, '-', turn) AS chunk_id
      FROM {conversations} WHERE turn = 0""")
    return chunks.assemble(envelopes(spark, sf_dir), first_turns)


@query("q_chunk_documents", f"""
  WITH landed AS ({LANDED_SQL}),
  firstrow AS (
    SELECT l.*, row_number() OVER (PARTITION BY knowledge_id, chunk_id ORDER BY page, pos) AS r FROM landed l QUALIFY r = 1)
  SELECT f.chunk_id, f.knowledge_id, 'conversation ' || f.conv_id AS title, f.content
  FROM firstrow f""")
def chunk_documents(spark, sf_dir):
    documents = on_tables(spark, sf_dir, """
      SELECT DISTINCT concat('conversation-', conv_id) AS knowledge_id, concat('conversation ', conv_id) AS title,
             'summary' AS description FROM {conversations}""")
    first = chunks.first_copies(chunks.chunk_rows(envelopes(spark, sf_dir)))
    return chunks.with_documents(first, documents).select("chunk_id", "knowledge_id", "title", "content")


# Assistant turns name the artifact of their conversation, some in capitals; the reply before
# last in a long conversation names another one as well.
MARKED = """
  SELECT concat('conversation-', conv_id) AS knowledge_id, turn AS chunk_index, CAST(1 AS BIGINT) AS page, turn AS pos,
         CASE WHEN role = 'assistant' THEN concat(text, ' see ARTIFACT:', own, ', ', lower('Artifact:'), other, '; xARTIFACT:', own)
              ELSE text END AS content
  FROM (SELECT *, UUID_OF_CONV AS own, UUID_OF_TURN AS other FROM {conversations}) c"""


def uuid_of(text_sql: str) -> str:
    parts = ", '-', ".join(f"substr(md5({text_sql}), {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"concat({parts})"


OWN = uuid_of("concat('artifact-', conv_id)")
OTHER = uuid_of("concat('artifact-', floor(turn / 4))").replace("floor(turn / 4)", "CAST(floor(turn / 4) AS BIGINT)")
MARKED = MARKED.replace("UUID_OF_CONV", OWN).replace("UUID_OF_TURN", OTHER)
LABEL = "ARTIFACT"
FOUND = f"""
  WITH c AS ({MARKED.replace("{conversations}", "conversations")}),
  m AS (SELECT knowledge_id, chunk_index, page, pos, unnest(ids) AS artifact_id, generate_subscripts(ids, 1) - 1 AS nth
        FROM (SELECT *, regexp_extract_all(content,
          '(?i)\\bARTIFACT:([0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}})\\b', 1) AS ids FROM c)),
  found AS (SELECT *, row_number() OVER (PARTITION BY knowledge_id, artifact_id ORDER BY chunk_index, page, pos, nth) AS r FROM m QUALIFY r = 1)"""


@query("q_markers", FOUND + " SELECT knowledge_id, artifact_id, chunk_index, page, pos, nth FROM found")
def markers(spark, sf_dir):
    return chunks.markers(on_tables(spark, sf_dir, MARKED), LABEL)


@query("q_marker_status", FOUND + f"""
  , known AS (SELECT {uuid_of("concat('artifact-', doc_id)")} AS artifact_id, source AS store_alias,
                     CASE WHEN n_chars > 1000 THEN 'hash mismatch' END AS problem FROM documents WHERE lang <> 'fr')
  SELECT d.knowledge_id, f.artifact_id,
         CASE WHEN f.artifact_id IS NULL THEN 'no_marker' WHEN k.artifact_id IS NULL THEN 'unavailable'
              ELSE coalesce(k.problem, 'loaded') END AS status,
         CASE WHEN k.artifact_id IS NOT NULL AND k.problem IS NULL THEN k.store_alias END AS store_alias
  FROM (SELECT DISTINCT 'conversation-' || conv_id AS knowledge_id FROM conversations) d
  LEFT JOIN found f ON d.knowledge_id = f.knowledge_id LEFT JOIN known k ON f.artifact_id = k.artifact_id""")
def marker_status(spark, sf_dir):
    index = on_tables(spark, sf_dir, f"""
      SELECT {uuid_of("concat('artifact-', doc_id)")} AS artifact_id, source AS store_alias,
             CASE WHEN n_chars > 1000 THEN 'hash mismatch' END AS problem FROM {{documents}} WHERE lang <> 'fr'""")
    documents = on_tables(spark, sf_dir, "SELECT DISTINCT concat('conversation-', conv_id) AS knowledge_id FROM {conversations}")
    return chunks.marker_status(documents, markers(spark, sf_dir), index)

"""Text rules over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from factline.functions import text
from factline.queries.registry import on_tables, query, table


@query("q_redact", r"""
  SELECT doc_id, regexp_replace(text, '(password|api_key|token)\s*=\s*[^\s;&]+', '\1=[REDACTED]', 'gi') AS text,
         regexp_matches(text, '(?i)(password|api_key|token)\s*=\s*[^\s;&]+') AS had_secret
  FROM documents""")
def redact(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    clean = text.redact(F.col("text"))
    return documents.select("doc_id", clean.alias("text"), (clean != F.col("text")).alias("had_secret"))


NAMES = """
  SELECT concat('archive.v2/', source, '-', doc_id, CASE lang WHEN 'en' THEN '.PDF' WHEN 'fr' THEN '.csv.gz'
                WHEN 'de' THEN '.jpeg' ELSE '' END) AS path FROM documents
  UNION ALL SELECT url FROM pages"""


@query("q_media_type", rf"""
  WITH n AS (SELECT path, regexp_extract(path, '[^/]*$') AS name FROM ({NAMES}))
  SELECT path, CASE WHEN regexp_matches(name, '(?i)[^.]\.pdf$') THEN 'application/pdf'
                    WHEN regexp_matches(name, '(?i)[^.]\.csv(\.gz)?$') THEN 'text/csv'
                    WHEN regexp_matches(name, '(?i)[^.]\.jpe?g$') THEN 'image/jpeg'
                    WHEN regexp_matches(name, '(?i)[^.]\.html?$') THEN 'text/html'
                    ELSE 'application/octet-stream' END AS media_type
  FROM n""")
def media_type(spark, sf_dir):
    names = on_tables(spark, sf_dir, NAMES.replace("FROM documents", "FROM {documents}").replace("FROM pages", "FROM {pages}"))
    return names.select("path", text.media_type(F.col("path")).alias("media_type"))


@query("q_text_titles", r"""
  SELECT page_id, regexp_extract(url, '[^/]*$') AS file_name,
         regexp_replace(regexp_extract(url, '[^/]*$'), '([^.])\.[^.]*$', '\1') AS file_stem
  FROM pages""")
def text_titles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", text.file_name(F.col("url")).alias("file_name"), text.file_stem(F.col("url")).alias("file_stem"))


@query("q_strip_fence", """
  SELECT doc_id, trim(text, chr(32) || chr(9) || chr(10) || chr(13)) AS body FROM documents""")
def strip_fence(spark, sf_dir):
    fenced = on_tables(spark, sf_dir, r"""
      SELECT doc_id, concat('  ```json\n', trim(BOTH ' \t\n\r' FROM text), '\n```\n') AS fenced FROM {documents}""")
    return fenced.select("doc_id", text.strip_fence(F.col("fenced")).alias("body"))


@query("q_number_parse", """
  SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_extendedprice AS DOUBLE) END AS value FROM lineitem""")
def number_parse(spark, sf_dir):
    told = on_tables(spark, sf_dir, """
      SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN '' ELSE CAST(l_extendedprice AS STRING) END AS told FROM {lineitem}""")
    return told.select("l_orderkey", "l_linenumber", text.number_or_null(F.col("told")).alias("value"))


@query("q_data_url", "SELECT page_id, 'data:text/html;base64,' || base64(encode(html)) AS url FROM pages")
def data_url(spark, sf_dir):
    pages = on_tables(spark, sf_dir, "SELECT page_id, encode(html, 'UTF-8') AS content FROM {pages}")
    return pages.select("page_id", text.data_url(F.col("content"), F.lit("text/html")).alias("url"))

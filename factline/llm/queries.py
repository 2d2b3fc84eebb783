"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.llm import (bloom, bpe, ctw, fuzzy, html, line_dedup, merkle, mixing, periodic, phrases, quality, simhash, substrings,
                          words)
from factline.storage import keep

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query, with the SQL it is checked against where there is one."""

    def wrap(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_html_main_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html.extract(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query("op2_fuzzy_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy.against_edits(table(spark, sf_dir, "documents"))


OP3 = r"""
WITH raw AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) > 1 AS again
    FROM (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS content
          FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 99)) AS i FROM raw WHERE length(h) >= 200))),
places AS (
    SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte FROM (SELECT doc_id, h, unnest(range(length(h) // 2)) AS i FROM raw)),
covered AS (
    SELECT p.doc_id, p.i, p.byte, coalesce(bool_or(s.again) OVER (
        PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), FALSE) AS gone
    FROM places p LEFT JOIN strings s ON s.doc_id = p.doc_id AND s.i = p.i),
runs AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS opens FROM covered)
SELECT d.doc_id, count(r.i) AS n_bytes, count(*) FILTER (WHERE r.gone) AS n_removed, count(*) FILTER (WHERE r.opens) AS n_spans,
       sha256(unhex(coalesce(string_agg(r.byte, '' ORDER BY r.i) FILTER (WHERE NOT r.gone), ''))) AS kept_sha256
FROM documents d LEFT JOIN runs r ON r.doc_id = d.doc_id GROUP BY d.doc_id"""


@query("op3_suffix_array_dedup", OP3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


OP4 = r"""
WITH lines AS (
    SELECT doc_id, i, line, translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
repeated AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
    SELECT l.*, r.key IS NOT NULL AND l.doc_id <> r.keeper AS dropped FROM lines l LEFT JOIN repeated r ON l.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query("op4_line_dedup", OP4)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP5 = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
    SELECT doc_id, i, min(doc_id) OVER (PARTITION BY content) < doc_id AS again
    FROM (SELECT doc_id, i, array_to_string(words[i + 1:i + 50], ' ') AS content
          FROM (SELECT doc_id, words, unnest(range(len(words) - 49)) AS i FROM split WHERE len(words) >= 50))),
places AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM split),
covered AS (
    SELECT p.doc_id, p.i, p.word, coalesce(bool_or(w.again) OVER (
        PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), FALSE) AS gone
    FROM places p LEFT JOIN windows w ON w.doc_id = p.doc_id AND w.i = p.i)
SELECT d.doc_id, count(c.i) AS n_words, count(*) FILTER (WHERE c.gone) AS n_removed,
       sha256(coalesce(string_agg(c.word, ' ' ORDER BY c.i) FILTER (WHERE NOT c.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN covered c ON c.doc_id = d.doc_id GROUP BY d.doc_id"""


@query("op5_phrase_automata_dedup", OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = phrases.kept_words(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op6_context_tree_scores")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return ctw.scores(table(spark, sf_dir, "documents"), held_out)


@query("op7_bpe_round_trip")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path)


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("tie")


@query("op9_source_mix")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "documents").select("doc_id", "source", words.n_words(F.col("text")).alias("size"))
    mixed = mixing.mix(keep(sized, "sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op10_simhash_groups")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


OP11 = r"""
WITH digests AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)"""


@query("op11_bloom_exact_dedup", OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom.verdicts(table(spark, sf_dir, "documents"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.with_planted_tail(table(spark, sf_dir, "documents")))


OP13 = r"""
WITH RECURSIVE fields AS (
    SELECT doc_id, source, coalesce(CAST(strlen(CAST(doc_id AS VARCHAR)) AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR), '-') AS i,
           coalesce(CAST(strlen(source) AS VARCHAR) || ':' || source, '-') AS s,
           coalesce(CAST(strlen(lang) AS VARCHAR) || ':' || lang, '-') AS l,
           coalesce(CAST(strlen(CAST(n_chars AS VARCHAR)) AS VARCHAR) || ':' || CAST(n_chars AS VARCHAR), '-') AS n, text,
           list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
                       lambda x, b: list_reduce(list_concat([xor(x, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                                lambda y, z: xor(y >> 1, (y & 1) * 3988292384))) AS inverted
    FROM documents),
leaves AS (
    SELECT doc_id, source, xor(inverted, 4294967295) % 5 = 0 AS hit,
           sha256(i || s || l || n || coalesce(CAST(strlen(text) AS VARCHAR) || ':' || text, '-')) AS leaf,
           sha256(i || s || l || n || coalesce(CAST(strlen(text) AS VARCHAR) || ':' || translate(
               text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS other
    FROM fields),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
nodes AS (
    SELECT source, 0 AS level, pos, leaf AS hash FROM placed
    UNION ALL
    SELECT source, level + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY source) AS others FROM nodes) WHERE others > 1
    GROUP BY source, level, pos // 16),
subroots AS (
    SELECT source, hash AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS top_pos
    FROM (SELECT *, max(level) OVER (PARTITION BY source) AS last FROM nodes) WHERE level = last),
uppers AS (
    SELECT 0 AS level, top_pos AS pos, subroot AS hash FROM subroots
    UNION ALL
    SELECT level + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER () AS others FROM uppers) WHERE others > 1
    GROUP BY level, pos // 16),
root AS (SELECT hash AS root FROM uppers ORDER BY level DESC LIMIT 1),
steps AS (
    SELECT p.doc_id, n.level, coalesce(string_agg(n.hash, '' ORDER BY n.pos) FILTER (WHERE n.pos < p.pos // CAST(16 ** n.level AS BIGINT)), '') AS before,
           coalesce(string_agg(n.hash, '' ORDER BY n.pos) FILTER (WHERE n.pos > p.pos // CAST(16 ** n.level AS BIGINT)), '') AS after
    FROM placed p JOIN (SELECT *, max(level) OVER (PARTITION BY source) AS last FROM nodes) n
        ON p.source IS NOT DISTINCT FROM n.source AND n.level < n.last AND n.pos // 16 = p.pos // CAST(16 ** (n.level + 1) AS BIGINT)
    GROUP BY ALL
    UNION ALL
    SELECT p.doc_id, 1000 + n.level, coalesce(string_agg(n.hash, '' ORDER BY n.pos) FILTER (WHERE n.pos < s.top_pos // CAST(16 ** n.level AS BIGINT)), ''),
           coalesce(string_agg(n.hash, '' ORDER BY n.pos) FILTER (WHERE n.pos > s.top_pos // CAST(16 ** n.level AS BIGINT)), '')
    FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
        JOIN (SELECT *, max(level) OVER () AS last FROM uppers) n
        ON n.level < n.last AND n.pos // 16 = s.top_pos // CAST(16 ** (n.level + 1) AS BIGINT)
    GROUP BY ALL),
paths AS (
    SELECT doc_id, string_agg(before || after, '' ORDER BY level) AS proof, list(before || ',' || after ORDER BY level) AS path
    FROM steps GROUP BY doc_id),
folded AS (
    SELECT p.doc_id, p.leaf, s.subroot, r.root, sha256(coalesce(h.proof, '')) AS proof_sha256,
           list_reduce(list_concat([CASE WHEN p.hit THEN p.other ELSE p.leaf END], coalesce(h.path, [])),
                       lambda got, step: sha256(split_part(step, ',', 1) || got || split_part(step, ',', 2))) AS folded_root
    FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source CROSS JOIN root r LEFT JOIN paths h ON p.doc_id = h.doc_id)
SELECT *, folded_root = root AS verified FROM folded"""


@query("op13_merkle_manifest", OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))

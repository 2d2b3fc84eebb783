"""A training corpus from raw documents: quality, repeated lines, near copies, source mix, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.llm import bpe, line_dedup, mixing, names, quality, simhash, words
from factline.storage import keep


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the rules reject."""
    aside, columns = names.set_aside(docs, "doc_id", "text")
    judged = quality.judge(aside, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.filter("kept").select(*columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop long lines that many documents share; n_chars follows."""
    aside, columns = names.set_aside(docs, "doc_id", "text", "n_chars")
    return line_dedup.dedup_lines(aside).withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return simhash.first_of_groups(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as its source's target asks."""
    aside, columns = names.set_aside(docs, "doc_id", "source", "text")
    mixed = mixing.mix(aside.withColumn("size", words.n_words(F.col("text"))), "size")
    return mixed.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and the hash of the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    decoded = bpe.decode(bpe.encode(docs.select("doc_id", "source", "text"), path).drop("text"), path)
    return decoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("line dedup", repeated_lines), ("SimHash near-dedup", near_copies),
          ("source mix", source_mix), ("BPE encoding", token_ids)]
#: The likelihood ratios, fingerprints and merges of the stages are beyond SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, storing what each one keeps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = keep(docs, "stage")
    return docs

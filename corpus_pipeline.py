"""Corpus preparation pipeline (part of the optional llm subpackage).

Five stages, each a function (spark, docs, sf_dir) -> DataFrame; all but the last
return the columns of ``documents``.  Every stage is written as Parquet to the
shared folder and read again as the next one's input, so a lost executor repeats
one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docshred.llm.common import table
from docshred.llm.cost_packing import pack_documents, piece_digest
from docshred.llm.crf_quality import keep_good
from docshred.llm.jaccard_join import row_key, similarity_components
from docshred.llm.spaced_seeds import decontaminate
from docshred.llm.token_secrets import redact
from docshred.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the line classifier rejects (score below 0.5)."""
    return keep_good(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (smallest id, then
    smallest text hash; null ids last).  Documents without a word are in no
    group and all stay; other rows equal in id and text count once."""
    docs = docs.select(*COLUMNS).withColumn("key", row_key("doc_id", "text"))
    groups = similarity_components(docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    first = groups.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(order)["key"].alias("key")).select("key")
    wordless = groups.where(F.col("group").isNull()).select("key").distinct()
    kept = docs.join(first, "key", "left_semi").dropDuplicates(["key"])
    return kept.unionAll(docs.join(wordless, "key", "left_semi")).select(*COLUMNS)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap a benchmark item."""
    return decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by a mark; no document goes."""
    clean = redact(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences."""
    return piece_digest(pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark_overlap", benchmark_overlap),
          ("secrets", secrets), ("packing", packing)]

# The stages learn models, tokenise and compare sets: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

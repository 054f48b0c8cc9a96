"""Registered queries of the corpus operators, and SQL where it can express them.

Each query applies its operator with production parameters to the whole table
and derives the contract's digest columns from the operator's real output.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docshred.llm.anchor_negatives import hard_negatives
from docshred.llm.common import table
from docshred.llm.cost_packing import pack_documents, piece_digest
from docshred.llm.crf_quality import score_quality
from docshred.llm.divergence_rules import judge
from docshred.llm.jaccard_join import similarity_components
from docshred.llm.periodic_runs import find_runs, plant, run_digest
from docshred.llm.ppm_language import identify
from docshred.llm.prefix_free_dedup import remove_substrings
from docshred.llm.span_dedup import WHOLE, remove_repeats
from docshred.llm.spaced_seeds import find_overlaps
from docshred.llm.token_secrets import find_secrets, span_list
from docshred.llm.toxicity_grammar import score_toxicity
from docshred.llm.warc_zstd import read_archives, train_dictionary, with_record_types, write_archives
from docshred.session import scratch_path

THRESHOLD = 0.7  # of the scores' predictions

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op2_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    write_archives(with_record_types(pages), path, train_dictionary(pages))
    return read_archives(spark, path, keep_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


OP2_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
     f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to, CASE WHEN again THEN NULL ELSE true END AS digest_ok
FROM (SELECT *, first IS NOT NULL AND page_id IS DISTINCT FROM first AS again
      FROM p LEFT JOIN f USING (payload_digest))
"""


def op3_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def op4_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), WHOLE)


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(span_list(F.col("spans"), base_only=True), 256).alias("base_sha256"),
                        span_list(F.col("spans")).alias("spans"))


def op8_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digest(pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, ranks=RANKS,
                                       pattern=public_tokenizers.PATTERN))


def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(find_runs(plant(table(spark, sf_dir, "documents"))))


def op12_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))


OP12_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
     w AS (SELECT doc_id, i, substr(x, CAST(2 * i + 1 AS BIGINT), 100) AS s
           FROM (SELECT doc_id, x, unnest(range(0, n - 49)) AS i FROM d)),
     f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
     r AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new
           FROM w JOIN f USING (s) WHERE first < doc_id),
     k AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
     g AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY doc_id, run),
     e AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS past FROM g),
     t AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS gone, count(*) AS spans, max(b) AS last,
                  string_agg(substr(x, 2 * past + 1, 2 * (a - past)), '' ORDER BY a) AS head
           FROM e JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""


def op13_anchor_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
                  CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
           FROM r AS a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
     p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id,
       positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 3
"""


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_crf_quality, op2_warc_dictionary, op3_divergence_rules, op4_toxicity_grammar, op5_sentence_spans,
        op6_spaced_seeds, op7_secret_scan, op8_cost_balanced_packing, op9_ppm_language, op10_jaccard_join,
        op11_periodic_runs, op12_prefix_free_dedup, op13_anchor_negatives)} | {
        "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_dictionary": OP2_SQL, "op12_prefix_free_dedup": OP12_SQL, "op13_anchor_negatives": OP13_SQL}

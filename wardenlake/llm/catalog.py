"""The registered queries of this folder, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardenlake.llm import byte_bpe, histogram_shards, language_spans, near_vectors, ngram_jaccard, ordinal_quality, paragraph_sketch, passage_alignment, periodic_runs, token_files, warc, whitening, whole_tokens
from wardenlake.llm.batches import table


def op1_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_sketch.compare_with_edits(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_join(table(spark, sf_dir, "documents"))


def op3_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_shards.shard_documents(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.coded_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), ranks)


def op6_passage_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_alignment.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal_quality.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_spans.predict_documents(table(spark, sf_dir, "documents"))


def op9_whole_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = public_tokenizers.path("word_bpe_49k.json")
    return whole_tokens.count_documents(table(spark, sf_dir, "documents"), words)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.cosine_components(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_paragraph_sketch": op1_paragraph_sketch,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_histogram_shards": op3_histogram_shards,
    "op4_token_files": op4_token_files,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_passage_alignment": op6_passage_alignment,
    "op7_ordinal_quality": op7_ordinal_quality,
    "op8_language_spans": op8_language_spans,
    "op9_whole_tokens": op9_whole_tokens,
    "op10_warc": op10_warc,
    "op11_near_vectors": op11_near_vectors,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op11_near_vectors": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
        ), ok AS MATERIALIZED (
            SELECT vec_id, x FROM v
            WHERE x IS NOT NULL AND len([c for c in x if c IS NULL OR NOT isfinite(c)]) = 0
              AND len([c for c in x if c <> 0]) > 0
        ), u AS (
            SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS norm FROM ok
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
            WHERE CASE WHEN len(a.x) = len(b.x) THEN list_dot_product(a.x, b.x) >= 0.95 * a.norm * b.norm END
        ), reach(a, b) AS (
            SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), c AS (
            SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
        ), n AS (
            SELECT l.a AS vec_id, count(*) AS n_links, count(*) FILTER (x.x = y.x) AS copies
            FROM links l JOIN v x ON l.a = x.vec_id JOIN v y ON l.b = y.vec_id GROUP BY l.a
        )
        SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept, coalesce(copies, 0) AS copies
        FROM v JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, sha256(coalesce(html, '')) AS payload_digest,
                   strlen(coalesce(html, '')) AS payload_bytes
            FROM pages
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_page FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_page IS NOT NULL AND page_id IS DISTINCT FROM first_page THEN 'revisit' ELSE 'response' END
                   AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first_page THEN first_page END AS refers_to
        FROM f
    """,
}

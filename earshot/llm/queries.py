"""The operators applied to their tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from earshot.llm.alignment import align
from earshot.llm.common import table
from earshot.llm.decontam import contamination
from earshot.llm.jaccard import jaccard_groups
from earshot.llm.ngram import language_model_scores
from earshot.llm.pieces import encode
from earshot.llm.pii import find_pii, pii_digest
from earshot.llm.prefix_trie import prefix_trie
from earshot.llm.quality import quality_scores
from earshot.llm.simhash import simhash_groups
from earshot.llm.substring import substring_dedup
from earshot.llm.token_counts import token_counts
from earshot.llm.topk import exact_top_k
from earshot.llm.toxicity import toxicity_scores

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), min_words=None)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(find_pii(table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), decoded=True)


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "pipeline": corpus_pipeline.run,
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality": op2_quality,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_simhash": op6_simhash,
    "op7_decontamination": op7_decontamination,
    "op8_pieces": op8_pieces,
    "op9_language_model": op9_language_model,
    "op10_token_counts": op10_token_counts,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_jaccard_join": op13_jaccard_join,
}

ORACLE: dict[str, str] = {
    "op5_exact_top_k": """
WITH fine AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM fine q JOIN fine c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
}

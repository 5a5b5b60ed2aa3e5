"""Thin queries over the standard tables, one for each operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_automaton, exact_dedup, language_id, mixing, near_dedup, pii, token_counts, token_output, topk_search, url_filter
from .shared import new_path

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.bpe_round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit_languages(docs.where(~language_id.held_out(F.col("doc_id"))))
    predicted = language_id.predict_languages(docs, model)
    return predicted.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.cached_token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), new_path(spark, "token-counts"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-output")
    token_output.write_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), path)
    rows = token_output.with_starts(token_output.ids_digest(spark.read.parquet(path)), path)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


#: Rules of the URL filter and what they say.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
#: The key of the query's pseudonyms; a deployment passes its own secret to the operator.
PII_KEY = b"linkloom documented query key"
#: Op 10's contract: shingles of two words.
TWO_WORDS = near_dedup.NearConfig(shingle_words=2)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_search.scaled_vectors(_table(spark, sf_dir, "embeddings"))
    return topk_search.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_copies(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.pseudonymised(_table(spark, sf_dir, "documents"), PII_KEY)
    return rows.select("doc_id", "text", F.size("spans").cast("long").alias("n_replaced"), "spans")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), TWO_WORDS)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_url_filters, op2_bpe_codec, op3_exact_dedup, op4_topk_search, op5_language_id, op6_token_counts, op7_token_output, op8_source_mixing, op9_pii_pseudonyms, op10_near_dedup, pipeline)
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": OP3_SQL, "op4_topk_search": OP4_SQL}


OP3_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
  FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY sha ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size
  FROM rows
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha AS text_sha256 FROM ranked
""".replace("\\\\", "\\")

OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

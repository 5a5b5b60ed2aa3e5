"""From raw documents to token ids: five stages, each over all rows that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import bpe_automaton, exact_dedup, language_id, mixing, near_dedup
from linkloom.llm.shared import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter, or that no language is likelier for than all others together, go."""
    model = language_id.fit_languages(docs.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.identified(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shingles of five words, similarity of 0.8 or more: one document of each group stays."""
    return near_dedup.without_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes as often as the mix takes it; one that it doesn't take goes."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe_automaton.bpe_encode(docs, vocabulary, keep=("lang", "source"))
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("source mixing", mix),
    ("BPE encoding", encode),
]

#: Naive Bayes, signatures and random rounding have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training corpus from raw documents: five stages, each written as Parquet and read again.

``STAGES`` names them in order. A stage gets what its predecessor kept and works on all of it; all
but the last return the columns of ``documents``. Stages drop documents, never parts of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fascicle.llm import decontamination, jaccard_join, language_id, mixing, token_shards
from fascicle.llm.queries import tokenizer_path
from fascicle.session import load, scratch_path

# Near copies: length of a shingle and similarity; op7's query has its own.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told stay; a missing lang is filled in.

    Where no row has a language to learn from, documents with a letter stay.
    """
    model = language_id.train(docs)
    if not model.languages:
        return language_id.with_letters(docs)
    found = language_id.predict(docs, model, *docs.columns)
    known = found.where(F.col("lang_pred") != language_id.UNKNOWN)
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (80 % of five-word shingles) stays."""
    return jaccard_join.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontamination.clean(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of sources, languages and topics."""
    return mixing.sample(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in indexed shards; one row per document as read back."""
    return token_shards.token_ids(docs, tokenizer_path()).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_shards", write_tokens),
]

# Suffix automata, banded alignment and a tokenizer cannot be said in SQL; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

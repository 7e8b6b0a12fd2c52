"""The operators' queries with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import load
from . import conversation_repair, decontamination, document_sketch, exact_dedup, html_extraction, jaccard_join, language_id, lm_scoring, mixing, sanitisation, spelling, token_shards, toxicity

WORD_BPE = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


@query(
    sql=r"""
    WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                      sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
         g AS (SELECT text_sha256, count(*) AS group_size, max(chars) AS chars FROM t GROUP BY 1),
         k AS (SELECT text_sha256, group_size, min(doc_id) AS keep_id FROM t JOIN g USING (text_sha256, chars) GROUP BY 1, 2)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN k USING (text_sha256)
    """
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def tokenizer_path() -> str:
    """The public word-level BPE file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(WORD_BPE)


@query()
def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_shards.token_ids(load(spark, sf_dir, "documents"), tokenizer_path())
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return language_id.identify(docs, "doc_id").select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents", "labels")
    found = toxicity.score(docs, toxicity.learn(docs, labels), "doc_id")
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query()
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(*load(spark, sf_dir, "documents", "benchmark"))


@query()
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of good quality."""
    docs, labels = load(spark, sf_dir, "documents", "labels")
    return lm_scoring.score_against(docs, labels.where("quality = 1"), "doc_id")


@query()
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(load(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


@query()
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_main_text(load(spark, sf_dir, "pages"), "page_id", "url")


@query(sql=mixing.sql())
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(load(spark, sf_dir, "documents"))


@query()
def op6_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitisation.find_personal_data(load(spark, sf_dir, "documents"))


@query(sql=document_sketch.sql())
def op11_document_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_sketch.edited_likeness(load(spark, sf_dir, "documents"))


@query(sql=spelling.sql())
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(load(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


@query()
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(load(spark, sf_dir, "conversations"))

"""Document flow: paged files to annotated, cleaned, filtered and embedded chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import bound, is_blank
from ..operators import chunking, columns, predicates, retrieval

# Shortest chunk kept, with and without image descriptions.
MIN_LENGTH = 200
MIN_LENGTH_PLAIN = 50
ANNOTATION_COLUMNS = ("ATA", "parts", "doc_type")


def prepare_chunks(pages: DataFrame, source: str = "md_img", annotation: str = "llm_output",
                   boilerplate: str | None = None, **chunking_options) -> DataFrame:
    """Assembled pages with model annotations to finished chunks."""
    chosen = pages.withColumn("json", F.when(is_blank("img-0"), F.col("json")).otherwise(F.col("json_img")))
    annotated = chunking.annotations(chosen, annotation, ANNOTATION_COLUMNS).withColumn("_body", F.col(source))
    kept = columns.drop_matching(annotated, r"(md|json_|img|images|llm|annot).*")
    chunks = chunking.recursive_chunks(kept, "_body", **chunking_options)
    return chunking.finish_chunks(chunks, boilerplate)


def filter_chunks(chunks: DataFrame, skip: list[tuple[str, str]], min_length: int = MIN_LENGTH) -> DataFrame:
    """Chunks longer than ``min_length`` whose columns differ from every (column, value) given."""
    return predicates.all_rules(
        chunks, [predicates.differs(c, v) for c, v in skip] + [predicates.exceeds("length", min_length)]
    )


def index_chunks(chunks: DataFrame, path: str, embedder: retrieval.Embedder) -> DataFrame:
    metadata = [c for c in ("doc", "doc_root", "json", "doc_type", "ATA", "parts") if c in chunks.columns]
    return retrieval.build_index(chunks, path, "chunk", "chunk_id", metadata, embedder)


def chunk_and_fold(documents: DataFrame, min_length: int = MIN_LENGTH_PLAIN) -> DataFrame:
    """Documents to fixed-stride chunks, short ones dropped, the rest joined per document.

    Everything happens inside the row. A document without a chunk long enough is left out.
    """
    kept = F.filter(chunking.fixed_pieces("text"), lambda c: F.length(c) > min_length)
    text = bound(kept, lambda k: F.when(F.size(k) > 0, F.array_join(k, "\n\n")))
    # the outer explode keeps the filter from computing the pieces a second time
    rows = documents.select(F.col("doc_id").alias("doc"), F.lit(0).cast("bigint").alias("part"), F.explode_outer(F.array(text)).alias("chunk_concat"))
    return rows.filter(F.col("chunk_concat").isNotNull())

"""Request flow: expand the request, search two banks, propose an answer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jsonops
from ..functions.scalars import col, is_blank
from ..operators import prompts, retrieval

# Roles a request may carry, and the default one.
ROLES = ("000", "100", "200", "300", "400", "500")
DEFAULT_ROLE = "000"
DEFAULT_MESSAGE = "Propose task description"


def normalise_requests(df: DataFrame, role: str = "role", message: str = "user_message", description: str = "description") -> DataFrame:
    """Unknown roles become the default; without a description the message describes the task."""
    known = F.when(col(role).isin(list(ROLES)), col(role)).otherwise(DEFAULT_ROLE)
    missing = is_blank(description)
    return df.withColumns({
        role: known,
        message: F.when(missing, F.lit(DEFAULT_MESSAGE)).otherwise(col(message)),
        description: F.when(missing, col(message)).otherwise(col(description)),
    })


def search(requests: DataFrame, request_id: str, query: str, index: DataFrame, id_column: str,
           fields: list[str], embedder: retrieval.Embedder, k: int = 10, candidates: int | None = None,
           diversity: float = 0.0, vector: str = "embedding") -> DataFrame:
    """Search context (one JSON list per request) for a text column of the requests.

    With a diversity above 0 the ``k`` results are chosen among ``candidates``.
    """
    asked = retrieval.embed_texts(requests.select(col(request_id).alias("query_id"), col(query).alias("_q")), "_q", embedder, output=vector)
    pool = max(candidates or k, k) if diversity > 0 else k
    found = retrieval.top_k(index, asked, pool, id_column, vector, "query_id", vector)
    if diversity > 0:
        found = retrieval.rerank_diverse(found, index, k, diversity, id_column, vector)
    rows = retrieval.result_rows(found, index, id_column, *fields)
    return retrieval.search_context(rows, "id", "score", *fields)


def answer_requests(requests: DataFrame, request_id: str, banks: Mapping[str, tuple[DataFrame, str, list[str]]],
                    embedder: retrieval.Embedder, templates: Mapping[str, str], model: prompts.Model = prompts.offline_model,
                    k: int = 10, sources: str | None = None) -> DataFrame:
    """Batch form of the request service.

    ``banks`` maps a result name to (index, id column, fields). A request that brings its own
    ``sources`` keeps them instead of the searches. Result: the request columns, the expanded
    query, one context per bank and the answer's label, description and comment.
    """
    asked = normalise_requests(requests)
    query = prompts.render(templates["query"], {c: c for c in ("role", "user_message", "description")})
    expanded = prompts.complete(asked, query, model).withColumn("query", jsonops.result_or_text("llm_output"))
    expanded = prompts.materialise(expanded.drop(*prompts.OUTPUT_COLUMNS))
    unanswered = expanded.filter(col(sources).isNull()) if sources else expanded
    for name, (index, id_column, fields) in banks.items():
        found = search(unanswered, request_id, "query", index, id_column, fields, embedder, k)
        side = found.select(F.col("query_id").alias(request_id), F.col("context").alias(f"_{name}"))
        expanded = expanded.join(side, request_id, "left")
        given = jsonops.field(sources, name) if sources else F.lit(None).cast("string")
        expanded = expanded.withColumn(name, F.coalesce(given, F.col(f"_{name}"), F.lit("[]"))).drop(f"_{name}")
    proposal = prompts.render(templates["propose"], {c: c for c in ("role", "user_message", "description", *banks)})
    answered = prompts.complete(expanded, proposal, model, expected="JSON_OBJECT")
    return prompts.extract_keys(
        answered.withColumnRenamed("description", "input_description"), "llm_output", ("label", "description", "comment")
    )

"""Exact similarity search over embedding tables and what is built on its results."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import col
from ..session import materialise, small_side

# Query vectors that tasks hold at once, and index rows scored at a time.
BLOCK_QUERIES = 4096
SLICE_ROWS = 1024
# Parts in which a query's partial results are merged before they meet.
MERGE_PARTS = 32
# Scores are compared after rounding, so that equal vectors tie whatever the summing order.
SCORE_DIGITS = 6

Embedder = Callable[[Sequence[str]], np.ndarray]


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1.0, norms)


def _matrix(column: pd.Series) -> np.ndarray:
    return _unit(np.array(column.tolist(), dtype=np.float64)) if len(column) else np.zeros((0, 0))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties by smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        candidates = np.flatnonzero(scores >= edge)
    else:
        candidates = np.arange(len(scores))
    return candidates[np.lexsort((ids[candidates], -scores[candidates]))][:k]


class _Running:
    """The best ``k`` (id, score) pairs per query seen so far."""

    def __init__(self, n: int, k: int):
        self.k, self.ids, self.scores = k, [np.array([])] * n, [np.array([])] * n
        self.floor = np.full(n, -np.inf)  # score a new row must reach to matter

    def add(self, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        for at in range(0, len(ids), SLICE_ROWS):
            self._add(queries, ids[at:at + SLICE_ROWS], vectors[at:at + SLICE_ROWS])

    def _add(self, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        block = queries @ vectors.T
        hits = ~(block < self.floor[:, None] - 10.0 ** -SCORE_DIGITS)  # rounding moves a score by half of that
        for q in np.flatnonzero(hits.any(axis=1)):
            new = np.flatnonzero(hits[q])
            rounded = np.round(block[q][new], SCORE_DIGITS) + 0.0
            new, rounded = new[rounded >= self.floor[q]], rounded[rounded >= self.floor[q]]
            if not len(new):
                continue
            all_ids = np.concatenate([self.ids[q], ids[new]]) if len(self.ids[q]) else ids[new]
            all_scores = np.concatenate([self.scores[q], rounded])
            keep = _best(all_ids, all_scores, self.k)
            self.ids[q], self.scores[q] = all_ids[keep], all_scores[keep]
            if len(keep) == self.k:
                self.floor[q] = self.scores[q][-1]

    def rows(self, query_ids: Sequence) -> pd.DataFrame:
        """Object columns throughout, so that ids of any type, and no rows at all, convert."""
        every = [(q, i, float(s)) for q, ids, scores in zip(query_ids, self.ids, self.scores) for i, s in zip(ids.tolist(), scores)]
        return pd.DataFrame(every, columns=["query_id", "id", "score"], dtype=object)


def top_k(index: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", vector: str = "embedding",
          query_id: str = "query_id", query_vector: str = "embedding", exclude_self: bool = False) -> DataFrame:
    """The ``k`` most similar index rows of every query by cosine: (query_id, id, score, rank).

    Queries are stored once, and equal vectors are searched once. The distinct ones are dealt into
    blocks of about ``BLOCK_QUERIES`` by a hash. A block's vectors are shared with all tasks; each task keeps its own best ``k`` per query while it
    streams its part of the index, so the index never moves and is read once for each block.
    Partial results, tasks x queries x k rows, are cut to k in parts of each query before they
    meet. Exact; ties go to the smaller id. The result is stored, so that what is built on it
    does not scan the index again.
    """
    id_type = index.schema[id_column].dataType.simpleString()
    schema = f"query_id bigint, id {id_type}, score double"
    want = k + 1 if exclude_self else k
    items = index.select(col(id_column).alias("id"), col(vector).alias("vector")).filter("vector is not null")
    # stored: an embedder behind the queries runs once, and every pass sees the same vectors
    asked = materialise(queries.select(col(query_id).alias("query_id"), col(query_vector).alias("vector")).filter("vector is not null"))
    vectors = materialise(asked.select("vector").distinct().withColumn("_v", F.monotonically_increasing_id()))
    blocks = max(1, math.ceil(vectors.count() / BLOCK_QUERIES))
    block = F.pmod(F.xxhash64("_v"), F.lit(blocks))
    shared = vectors.select(F.col("_v").alias("query_id"), "vector")
    partial = _scan(items, shared.filter(block == 0).toPandas(), want, schema)
    for b in range(1, blocks):
        partial = partial.unionByName(_scan(items, shared.filter(block == b).toPandas(), want, schema))
    best = F.col("score").desc(), F.col("id")

    def ranked(rows: DataFrame, n: int, *keys: str) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*best)).cast("bigint")).filter(F.col("rank") <= n)

    parts = partial.withColumnRenamed("query_id", "_v").withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(MERGE_PARTS)))
    found = materialise(ranked(ranked(parts, want, "_v", "_part"), want, "_v").select("_v", "id", "score"))
    # a query takes the results of its vector, want of them at most
    results = asked.join(vectors, "vector").select("query_id", "_v").join(found, "_v").drop("_v")
    if exclude_self:
        results = results.filter(F.col("id") != F.col("query_id"))
    return materialise(ranked(results, k, "query_id").select("query_id", "id", "score", "rank"))


def _scan(items: DataFrame, shared: pd.DataFrame, k: int, schema: str) -> DataFrame:
    query_ids = shared["query_id"].tolist()
    held = items.sparkSession.sparkContext.broadcast(_matrix(shared["vector"]))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = _Running(len(query_ids), k)
        for batch in batches:
            if len(batch) and query_ids:
                best.add(held.value, batch["id"].to_numpy(), _matrix(batch["vector"]))
        yield best.rows(query_ids)

    return items.mapInPandas(scan, schema)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity as a plain expression, for a handful of rows."""
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def metadata_filter(index: DataFrame, **equal: object) -> DataFrame:
    """Restrict the index by metadata before searching; reaches the scan of a stored index."""
    for name, value in equal.items():
        index = index.filter(col(name).isin(value) if isinstance(value, (list, tuple)) else col(name) == value)
    return index


def above_score(results: DataFrame, threshold: float = 0.5) -> DataFrame:
    return results.filter(F.col("score") >= threshold)


def rerank_diverse(candidates: DataFrame, index: DataFrame, k: int, diversity: float = 0.1,
                   id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Choose ``k`` of each query's candidates, trading relevance against similarity to those
    already chosen (maximal marginal relevance, weight 1 - diversity on relevance).

    ``candidates`` comes from ``top_k``, so one group is at most its ``k`` rows.
    """
    vectors = index.select(col(id_column).alias("id"), col(vector).alias("vector"))
    q_type = candidates.schema["query_id"].dataType.simpleString()
    id_type = candidates.schema["id"].dataType.simpleString()
    keep = 1.0 - diversity

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["score", "id"], ascending=[False, True]).reset_index(drop=True)
        unit = _matrix(group["vector"])
        alike = np.round(unit @ unit.T, SCORE_DIGITS)
        relevance = group["score"].to_numpy()
        nearest = np.zeros(len(group))
        left, picked = list(range(len(group))), []
        while left and len(picked) < k:
            gain = np.round(keep * relevance[left] - diversity * nearest[left], SCORE_DIGITS + 2)
            best = left.pop(int(np.argmax(gain)))
            nearest = alike[best].copy() if not picked else np.maximum(nearest, alike[best])
            picked.append(best)
        return group.loc[picked, ["query_id", "id", "score"]].assign(rank=range(1, len(picked) + 1))

    joined = vectors.join(small_side(candidates.select("query_id", "id", "score")), "id")
    return joined.groupBy("query_id").applyInPandas(choose, f"query_id {q_type}, id {id_type}, score double, rank bigint")


def fuse_ranks(*results: DataFrame, constant: int = 60, k: int | None = None) -> DataFrame:
    """Reciprocal-rank fusion: sum of 1 / (constant + rank) per query and item over the lists."""
    every = results[0].select("query_id", "id", "rank")
    for r in results[1:]:
        every = every.unionByName(r.select("query_id", "id", "rank"))
    fused = every.groupBy("query_id", "id").agg(F.sum(1.0 / (F.col("rank") + constant)).alias("fused"))
    w = W.partitionBy("query_id").orderBy(F.round("fused", 9).desc(), "id")
    ranked = fused.withColumn("rank", F.row_number().over(w).cast("bigint"))
    return ranked.filter(F.col("rank") <= k) if k else ranked


def result_rows(results: DataFrame, index: DataFrame, id_column: str, *columns: str) -> DataFrame:
    """Search results with columns of the index rows they point to; the index is not shuffled
    for a result of ordinary size."""
    return index.select(col(id_column).alias("id"), *map(col, columns)).join(small_side(results), "id")


def search_context(rows: DataFrame, *fields: str, output: str = "context") -> DataFrame:
    """One JSON array per query, its records in rank order; at most k records meet."""
    record = F.struct(F.col("rank"), F.struct(*map(col, fields)).alias("r"))
    ordered = F.transform(F.array_sort(F.collect_list(record)), lambda x: x["r"])
    return rows.groupBy("query_id").agg(F.to_json(ordered).alias(output))


def hashing_embedder(dimensions: int = 64) -> Embedder:
    """Offline stand-in for an embedding model: counts of words per SHA-1 bucket."""

    def embed(texts: Sequence[str]) -> np.ndarray:
        import hashlib
        from functools import lru_cache

        @lru_cache(maxsize=100_000)
        def bucket(word: str) -> int:
            return int(hashlib.sha1(word.encode("utf-8")).hexdigest()[:8], 16) % dimensions

        out = np.zeros((len(texts), dimensions))
        for i, text in enumerate(texts):
            for word in (text or "").lower().split():
                out[i, bucket(word)] += 1.0
        return out

    return embed


def embed_texts(df: DataFrame, text: str, embedder: Embedder, batch: int = 1000, output: str = "embedding") -> DataFrame:
    """Add the unit-length vector of a text column, ``batch`` texts per model call.

    Only the text is sent to Python. The model object reaches each task with the function.
    """

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            blocks = [_unit(np.asarray(embedder(part.iloc[i:i + batch].tolist()), dtype=np.float64))
                      for i in range(0, len(part), batch)]
            yield pd.Series([row.astype(np.float32) for b in blocks for row in b], index=part.index, dtype=object)

    return df.withColumn(output, run.asNondeterministic()(col(text)))


def build_index(df: DataFrame, path: str, text: str, id_column: str, metadata: Sequence[str],
                embedder: Embedder, batch: int = 1000) -> DataFrame:
    """Write (id, text, metadata, unit vector) as Parquet, replacing an older index."""
    from ..sources.files import save_table

    columns = list(dict.fromkeys([id_column, text, *metadata]))
    return save_table(embed_texts(df.select(*map(col, columns)), text, embedder, batch), path)

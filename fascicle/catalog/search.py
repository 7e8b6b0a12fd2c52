"""Similarity search over the whole embedding table.

The queries are the mean vectors of the labels: Spark derives them from the whole table, and
every search scans the whole index.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import retrieval, text_index, vector_index
from ..session import load, scratch_path
from .registry import query


def label_means(embeddings, combine=F.avg):
    """(query_id, embedding): the mean vector of every label, or another combination."""
    values = embeddings.select("label", F.posexplode("embedding").alias("pos", "x"))
    means = values.groupBy("label", "pos").agg(combine(F.col("x").cast("double")).alias("m"))
    # one list per label, as long as a vector has dimensions
    vector = F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda v: v["m"])
    return means.groupBy(F.col("label").alias("query_id")).agg(vector.alias("embedding"))


def _scored_sql(combine="avg", name="s"):
    return f"""a_{name} AS (SELECT label, p, {combine}(x) AS m FROM v GROUP BY ALL),
    q_{name} AS (SELECT label AS query_id, list(m ORDER BY p) AS e FROM a_{name} GROUP BY 1),
    {name} AS (SELECT query_id, vec_id AS id, label, round(list_cosine_similarity(e, CAST(embedding AS DOUBLE[])), 6) AS score FROM q_{name}, embeddings)"""


_VALUES = "WITH v AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS p FROM embeddings)"
_SCORED = f"{_VALUES}, {_scored_sql()}"


def _ranked_sql(k, where="TRUE", name="r", scores="s"):
    return f"""{name} AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
      FROM {scores} WHERE {where} QUALIFY rank <= {k})"""


@query("RT1", "SL8", sql=f"{_SCORED}, {_ranked_sql(10)} SELECT * FROM r")
def similarity_top_k(spark, sf):
    embeddings = load(spark, sf, "embeddings")
    return retrieval.top_k(embeddings, label_means(embeddings), 10)


def _diverse_sql(k, candidates, diversity):
    """Greedy choice unrolled: one step per rank."""
    keep = 1 - diversity
    ctes = [_SCORED, _ranked_sql(candidates, name="c"), """x AS (SELECT c1.query_id, c1.id AS a, c2.id AS b,
      round(list_cosine_similarity(CAST(e1.embedding AS DOUBLE[]), CAST(e2.embedding AS DOUBLE[])), 6) AS alike
      FROM c c1 JOIN c c2 ON c1.query_id = c2.query_id JOIN embeddings e1 ON e1.vec_id = c1.id JOIN embeddings e2 ON e2.vec_id = c2.id)""",
            "p1 AS (SELECT query_id, id, score, CAST(1 AS BIGINT) AS rank FROM c WHERE c.rank = 1)"]
    for i in range(2, k + 1):
        chosen = " UNION ALL ".join(f"SELECT * FROM p{j}" for j in range(1, i))
        ctes.append(f"""p{i} AS (SELECT c.query_id, c.id, c.score, CAST({i} AS BIGINT) AS rank FROM c
          JOIN (SELECT x.query_id, x.a, max(x.alike) AS near FROM x JOIN ({chosen}) p ON p.query_id = x.query_id AND p.id = x.b GROUP BY ALL) n
          ON n.query_id = c.query_id AND n.a = c.id WHERE (c.query_id, c.id) NOT IN (SELECT (query_id, id) FROM ({chosen}))
          QUALIFY row_number() OVER (PARTITION BY c.query_id ORDER BY round({keep} * c.score - {diversity} * n.near, 8) DESC, c.rank) = 1)""")
    return ", ".join(ctes) + " " + " UNION ALL ".join(f"SELECT * FROM p{j}" for j in range(1, k + 1))


@query("RT2", sql=_diverse_sql(10, 20, 0.25))
def diverse_reranking(spark, sf):
    embeddings = load(spark, sf, "embeddings")
    candidates = retrieval.top_k(embeddings, label_means(embeddings), 20)
    return retrieval.rerank_diverse(candidates, embeddings, 10, 0.25)


@query("RT3", sql=f"{_SCORED}, {_ranked_sql(16, 'label IN (1, 3, 5)')} SELECT * FROM r")
def filtered_search(spark, sf):
    embeddings = load(spark, sf, "embeddings")
    return retrieval.top_k(retrieval.metadata_filter(embeddings, label=[1, 3, 5]), label_means(embeddings), 16)


@query("RT4", sql=f"{_SCORED}, {_ranked_sql(20)} SELECT * FROM r WHERE score >= 0.25")
def search_above_threshold(spark, sf):
    embeddings = load(spark, sf, "embeddings")
    return retrieval.above_score(retrieval.top_k(embeddings, label_means(embeddings), 20), 0.25)


@query("RT5", sql=f"""{_SCORED}, {_scored_sql('max', 'z')}, {_ranked_sql(20, name='r1')}, {_ranked_sql(20, name='r2', scores='z')},
    f AS (SELECT query_id, id, sum(1.0::DOUBLE / (60 + rank)) AS fused FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2) GROUP BY ALL)
    SELECT query_id, id, round(fused, 9) AS fused, row_number() OVER (PARTITION BY query_id ORDER BY round(fused, 9) DESC, id) AS rank
    FROM f QUALIFY rank <= 10""")
def fused_rankings(spark, sf):
    embeddings = load(spark, sf, "embeddings")
    by_mean = retrieval.top_k(embeddings, label_means(embeddings), 20)
    by_peak = retrieval.top_k(embeddings, label_means(embeddings, F.max), 20)
    return retrieval.fuse_ranks(by_mean, by_peak, k=10).withColumn("fused", F.round("fused", 9))


@query("RT6", sql=f"{_SCORED}, {_ranked_sql(10)} SELECT r.query_id, r.id, r.score, r.rank, e.label FROM r JOIN embeddings e ON e.vec_id = r.id")
def search_result_rows(spark, sf):
    embeddings = load(spark, sf, "embeddings")
    found = retrieval.top_k(embeddings, label_means(embeddings), 10)
    return retrieval.result_rows(found, embeddings, "vec_id", "label").select("query_id", "id", "score", "rank", "label")


@query("RT7", sql=f"""{_SCORED}, {_ranked_sql(10)} SELECT query_id, '[' || string_agg('{{"id":' || CAST(r.id AS VARCHAR) || ',"label":' || CAST(e.label AS VARCHAR) || '}}', ',' ORDER BY rank) || ']' AS context
    FROM r JOIN embeddings e ON e.vec_id = r.id GROUP BY 1""")
def search_context_records(spark, sf):
    embeddings = load(spark, sf, "embeddings")
    found = retrieval.top_k(embeddings, label_means(embeddings), 10)
    return retrieval.search_context(retrieval.result_rows(found, embeddings, "vec_id", "label"), "id", "label")


_HASHED = r"""WITH t AS (SELECT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS w FROM documents),
    b AS (SELECT doc_id, CAST('0x' || substr(sha1(w), 1, 8) AS BIGINT) % 64 AS pos, count(*) AS n FROM t WHERE w <> '' GROUP BY ALL),
    l AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM b GROUP BY 1)"""


@query("RT0", sql=_HASHED + " SELECT doc_id, lang, pos, round(CAST(CAST(n / norm AS FLOAT) AS DOUBLE), 5) AS weight FROM b JOIN l USING (doc_id) JOIN documents USING (doc_id)")
def built_index(spark, sf):
    path = scratch_path(spark, "index")
    index = retrieval.build_index(load(spark, sf, "documents"), path, "text", "doc_id", ["lang", "source"], retrieval.hashing_embedder())
    cells = index.select("doc_id", "lang", F.posexplode("embedding").alias("pos", "w")).filter("w > 0")
    return cells.select("doc_id", "lang", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("w").cast("double"), 5).alias("weight"))


CELLS = 48

_FIFTIETH = """WITH s AS (SELECT q.vec_id AS query_id, e.vec_id AS id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 6) AS score
  FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0 AND e.vec_id <> q.vec_id)"""


@query("RT0", "RT1", "SL8", sql=f"{_FIFTIETH}, {_ranked_sql(10)} SELECT * FROM r")
def nearest_in_cells(spark, sf):
    """The ten nearest rows of every row whose id is divisible by 50, by the index in cells."""
    embeddings = load(spark, sf, "embeddings")
    path = scratch_path(spark, "cells")
    vector_index.build_cells(embeddings, path, CELLS)
    asked = embeddings.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vector_index.search_cells(spark, path, asked, 10, exclude_self=True)


@query("RT0", "RT3", sql=f"{_SCORED}, {_ranked_sql(16, 'label IN (1, 3, 5)')} SELECT * FROM r")
def filtered_search_in_cells(spark, sf):
    """The label filter is applied to the rows of the visited cells."""
    embeddings = load(spark, sf, "embeddings")
    path = scratch_path(spark, "cells")
    vector_index.build_cells(embeddings, path, CELLS, metadata=["label"])
    return vector_index.search_cells(spark, path, label_means(embeddings), 16, where=F.col("label").isin(1, 3, 5))


_BM25 = r"""WITH t AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
  z AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM t),
  f AS (SELECT id, size, term, count(*) AS times FROM (SELECT id, len(w) AS size, unnest(w) AS term FROM t) GROUP BY ALL),
  h AS (SELECT term, count(*) AS having_ FROM f GROUP BY 1),
  q AS (SELECT item_id AS query_id, unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+'))) AS term FROM benchmark),
  bm AS (SELECT query_id, id, round(sum(ln(1 + (n - having_ + 0.5) / (having_ + 0.5)) * times * 2.2 / (times + 1.2 * (0.25 + 0.75 * size / mean))), 6) AS score
        FROM q JOIN f USING (term) JOIN h USING (term), z GROUP BY ALL)"""


def benchmark_words(spark, sf, k):
    docs, items = load(spark, sf, "documents", "benchmark")
    path = scratch_path(spark, "postings")
    text_index.build_postings(docs, path, "text", "doc_id")
    return text_index.search_terms(spark, path, items.select(F.col("item_id").alias("query_id"), "text"), k)


@query("RT0", "RT1", sql=f"{_BM25}, {_ranked_sql(10, scores='bm')} SELECT * FROM r")
def best_by_words(spark, sf):
    """The ten best documents of every benchmark item by BM25, by the inverted index."""
    return benchmark_words(spark, sf, 10)


@query("RT5", sql=f"""{_BM25}, {_ranked_sql(20, name='r1', scores='bm')},
    s AS (SELECT q.item_id AS query_id, e.vec_id AS id, round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 6) AS score
          FROM benchmark q JOIN embeddings v ON v.vec_id = q.item_id, embeddings e), {_ranked_sql(20, name='r2')},
    y AS (SELECT query_id, id, sum(1.0::DOUBLE / (60 + rank)) AS fused FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2) GROUP BY ALL)
    SELECT query_id, id, round(fused, 9) AS fused, row_number() OVER (PARTITION BY query_id ORDER BY round(fused, 9) DESC, id) AS rank FROM y QUALIFY rank <= 10""")
def hybrid_rankings(spark, sf):
    """Word search and vector search fused by rank; a document's vector is the embedding of its id."""
    embeddings, items = load(spark, sf, "embeddings", "benchmark")
    path = scratch_path(spark, "cells")
    vector_index.build_cells(embeddings, path, CELLS)
    asked = items.select(F.col("item_id").alias("query_id")).join(embeddings.select(F.col("vec_id").alias("query_id"), "embedding"), "query_id")
    by_vector = vector_index.search_cells(spark, path, asked, 20)
    return retrieval.fuse_ranks(benchmark_words(spark, sf, 20), by_vector, k=10).withColumn("fused", F.round("fused", 9))

"""Search, re-ranking and fusion against brute force."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from fascicle.operators import retrieval
from fascicle.plans import requests as request_flow


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(600, 8))
    data[300:340] = data[5]  # a block of equal vectors, so that scores tie
    df = spark.createDataFrame([(i, [float(x) for x in v], i % 4) for i, v in enumerate(data)], "vec_id bigint, embedding array<double>, label int")
    return df.repartition(5).cache(), data


def brute(data, queries, k, exclude=False):
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    out = {}
    for q in queries:
        scores = np.round(unit @ unit[q], 6)
        order = [int(i) for i in sorted(range(len(data)), key=lambda i: (-scores[i], i)) if not (exclude and i == q)]
        out[q] = order[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


def asked(df, n):
    return df.filter(F.col("vec_id") < n).select(F.col("vec_id").alias("query_id"), "embedding")


def test_shared_scan(vectors):
    df, data = vectors
    assert found(retrieval.top_k(df, asked(df, 20), 12)) == brute(data, range(20), 12)


def test_blocks_of_queries_give_the_same(vectors, monkeypatch):
    df, data = vectors
    monkeypatch.setattr(retrieval, "BLOCK_QUERIES", 10)
    monkeypatch.setattr(retrieval, "SLICE_ROWS", 16)
    assert found(retrieval.top_k(df, asked(df, 150), 7, exclude_self=True)) == brute(data, range(150), 7, True)


def test_fewer_rows_than_k_and_no_queries(vectors):
    df, data = vectors
    few = df.filter("vec_id < 3")
    assert {q: len(v) for q, v in found(retrieval.top_k(few, asked(df, 2), 10)).items()} == {0: 3, 1: 3}
    assert retrieval.top_k(df, asked(df, 0), 10).count() == 0
    assert retrieval.top_k(df.filter("vec_id < 0"), asked(df, 2), 10).count() == 0


def test_zero_vectors_score_zero(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "vec_id bigint, embedding array<double>")
    q = spark.createDataFrame([("q", [2.0, 0.0])], "query_id string, embedding array<double>")
    assert [(r["id"], r["score"]) for r in retrieval.top_k(df, q, 2).orderBy("rank").collect()] == [(2, 1.0), (1, 0.0)]


def test_no_diversity_means_top_k(vectors):
    df, data = vectors
    candidates = retrieval.top_k(df, asked(df, 8), 20)
    assert found(retrieval.rerank_diverse(candidates, df, 5, 0.0)) == brute(data, range(8), 5)


def test_diversity_matches_greedy(vectors):
    df, data = vectors
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    alike = np.round(unit @ unit.T, 6)
    got = found(retrieval.rerank_diverse(retrieval.top_k(df, asked(df, 8), 20), df, 6, 0.5))
    for q, pool in brute(data, range(8), 20).items():
        picked = []
        while len(picked) < 6:
            gain = {i: round(0.5 * alike[q, i] - 0.5 * max((alike[i, j] for j in picked), default=0.0), 8) for i in pool if i not in picked}
            picked.append(max(gain, key=lambda i: (gain[i], -pool.index(i))))
        assert got[q] == picked


def test_cosine_expression_agrees(vectors):
    df, data = vectors
    one = df.filter("vec_id = 0").select(F.col("embedding").alias("e"))
    top = df.crossJoin(one).select("vec_id", F.round(retrieval.cosine(F.col("embedding"), F.col("e")), 6).alias("s")).orderBy(F.desc("s"), "vec_id").limit(5)
    assert [r["vec_id"] for r in top.collect()] == brute(data, [0], 5)[0]


def test_filter_threshold_fusion(vectors):
    df, _ = vectors
    some = retrieval.metadata_filter(df, label=2)
    results = retrieval.top_k(some, asked(df, 3), 10)
    assert {r["id"] % 4 for r in results.collect()} == {2}
    assert all(r["score"] >= 0.3 for r in retrieval.above_score(results, 0.3).collect())
    fused = retrieval.fuse_ranks(results, results, k=4).collect()
    assert len(fused) == 12 and all(abs(r["fused"] - 2 / (60 + r["rank"])) < 1e-12 for r in fused)


def test_context_is_ordered(spark, vectors):
    df, data = vectors
    rows = retrieval.result_rows(retrieval.top_k(df, asked(df, 2), 5), df, "vec_id", "label")
    out = {r["query_id"]: r["context"] for r in retrieval.search_context(rows, "id").collect()}
    assert out[0] == "[" + ",".join(f'{{"id":{i}}}' for i in brute(data, [0], 5)[0]) + "]"


def test_embedding_batches_and_unit_length(spark):
    sizes = []

    def embed(texts):
        assert len(texts) <= 7
        return np.array([[len(t or ""), 1.0] for t in texts])

    df = spark.createDataFrame([(i, "x" * i) for i in range(50)] + [(99, None)], "i int, t string").coalesce(1)
    rows = retrieval.embed_texts(df, "t", embed, batch=7).collect()
    assert len(rows) == 51 and all(abs(np.linalg.norm(r["embedding"]) - 1) < 1e-6 for r in rows) and not sizes


def test_index_of_chunks_answers_a_search(spark):
    from fascicle.plans import documents
    from fascicle.session import scratch_path

    rows = [("d 0", "wing spar crack", "d", "52"), ("d 1", "door seal leak", "d", "53"), ("e 0", "spar crack repair", "e", "52")]
    chunks = spark.createDataFrame(rows, "chunk_id string, chunk string, doc string, ATA string")
    embed = retrieval.hashing_embedder(256)
    index = documents.index_chunks(chunks, scratch_path(spark, "index"), embed)
    assert set(index.columns) == {"chunk_id", "chunk", "doc", "ATA", "embedding"}
    asked = spark.createDataFrame([("q", "wing spar crack")], "rid string, t string")
    for diversity, want in ((0.0, ["d 0", "e 0"]), (0.9, ["d 0", "d 1"])):
        found = request_flow.search(asked, "rid", "t", index, "chunk_id", ["doc"], embed, k=2, candidates=3, diversity=diversity)
        assert [r["id"] for r in json.loads(found.first()["context"])] == want


def test_missing_vectors_are_left_out(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None)], "vec_id string, embedding array<double>")
    q = df.select(F.col("vec_id").alias("query_id"), "embedding")
    assert found(retrieval.top_k(df, q, 3)) == {"a": ["a"]}


def test_requests_are_searched_and_answered(spark):
    embed = retrieval.hashing_embedder(128)
    bank = spark.createDataFrame([("n1", "seal leak on door", "53"), ("n2", "spar crack", "57"), ("n3", None, "0")], "nid string, text string, code string")
    index = retrieval.embed_texts(bank, "text", embed)
    requests = spark.createDataFrame(
        [("r1", "100", "Help", "door seal leak", None), ("r2", "x", "spar crack", None, None), ("r3", "000", "Help", "spar", '{"nc": [{"id": "given"}]}')],
        "rid string, role string, user_message string, description string, sources string")
    templates = {"query": "{{description}}", "propose": "{{role}}|{{description}}|{{nc}}"}
    seen = lambda system, user: user if "|" not in user else json.dumps({"label": user.split("|")[0], "description": "d", "comment": user.split("|")[2]})
    out = request_flow.answer_requests(requests, "rid", {"nc": (index, "nid", ["code"])}, embed, templates, seen, k=1, sources="sources")
    rows = {r["rid"]: r for r in out.collect()}
    assert json.loads(rows["r1"]["nc"])[0]["id"] == "n1" and json.loads(rows["r2"]["nc"])[0]["id"] == "n2"
    assert json.loads(rows["r3"]["nc"]) == [{"id": "given"}]
    assert rows["r2"]["label"] == "000" and rows["r2"]["input_description"] == "spar crack" and rows["r1"]["llm_validation_status"] == "VALID"
    assert rows["r1"]["comment"] == rows["r1"]["nc"]


def test_request_defaults(spark):
    df = spark.createDataFrame([(1, "999", "Hi", None), (2, "300", "Hi", "D")], "rid int, role string, user_message string, description string")
    a, b = request_flow.normalise_requests(df).orderBy("rid").collect()
    assert (a["role"], a["user_message"], a["description"]) == ("000", request_flow.DEFAULT_MESSAGE, "Hi")
    assert (b["role"], b["user_message"], b["description"]) == ("300", "Hi", "D")

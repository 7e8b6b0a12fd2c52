import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fascicle.operators import retrieval, vector_index


def clustered(spark, n=3000, groups=40, width=16, seed=1, hot=0.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, width)) * 4
    which = np.where(rng.random(n) < hot, 0, rng.integers(groups, size=n))
    rows = [(i, (middles[g] + rng.normal(size=width) * 0.3).tolist(), int(g) % 3) for i, g in enumerate(which)]
    rows += [(n, [0.0] * width, 0), (n + 1, None, 0), (n + 2, rows[5][1], 1), (n + 3, rows[5][1], 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)


def same(found, wanted):
    return sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def asked_of(index, step=50):
    return index.filter(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("query_id"), "embedding")


@pytest.mark.parametrize("cells,k", [(1, 3), (40, 10), (200, 25), (40, 5000)])
def test_equal_to_a_full_scan(spark, tmp_path, cells, k):
    index = clustered(spark, 1200)
    vector_index.build_cells(index, str(tmp_path / "i"), cells, sample=700)
    asked = asked_of(index, 100)
    wanted = retrieval.top_k(index, asked, k)
    assert same(vector_index.search_cells(spark, str(tmp_path / "i"), asked, k), wanted)


def test_few_cells_are_read(spark, tmp_path):
    index, rounds = clustered(spark), []
    path = str(tmp_path / "i")
    vector_index.build_cells(index, path, 60, metadata=["label"])
    asked = asked_of(index.filter("vec_id < 3000"), 1500)
    found = vector_index.search_cells(spark, path, asked, 5, on_round=lambda q, c: rounds.append(c))
    assert same(found, retrieval.top_k(index, asked, 5))
    assert sum(rounds) <= 12
    rows = vector_index.visited_rows(spark, path, [3, 4])
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: .*cell#\d+ IN \(3,4\)", plan)
    assert rows.select("cell").distinct().count() == 2


def test_metadata_self_and_zero_queries(spark, tmp_path):
    index = clustered(spark, 900)
    path = str(tmp_path / "i")
    vector_index.build_cells(index, path, 25, metadata=["label"])
    asked = asked_of(index, 150).unionByName(spark.createDataFrame([(-1, [0.0] * 16), (-2, None)], "query_id long, embedding array<double>"))
    assert same(vector_index.search_cells(spark, path, asked, 7, where=F.col("label") == 2), retrieval.top_k(index.filter("label = 2"), asked, 7))
    assert same(vector_index.search_cells(spark, path, asked, 7, exclude_self=True), retrieval.top_k(index, asked, 7, exclude_self=True))


def test_large_cell_and_popular_cell_are_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_index, "TILE_ROWS", 100)
    monkeypatch.setattr(vector_index, "PART_QUERIES", 20)
    index = clustered(spark, 1500, groups=10, hot=0.5)
    path = str(tmp_path / "i")
    vector_index.build_cells(index, path, 10)
    asked = asked_of(index, 10)
    assert same(vector_index.search_cells(spark, path, asked, 4), retrieval.top_k(index, asked, 4))


def test_empty(spark, tmp_path):
    index = clustered(spark, 20)
    path = str(tmp_path / "i")
    vector_index.build_cells(index.limit(0), path, 5)
    assert vector_index.search_cells(spark, path, asked_of(index, 5), 3).collect() == []
    path = str(tmp_path / "j")
    vector_index.build_cells(index, path, 5)
    assert vector_index.search_cells(spark, path, asked_of(index, 5).limit(0), 3).collect() == []

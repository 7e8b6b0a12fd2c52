import datetime
import random

import pytest
from pyspark.sql import functions as F

from fascicle.functions import tables
from fascicle.operators import chunking, joins, sketches

DAY = datetime.date(2020, 1, 1)


def dated(spark, n, names, seed, hot=0.0):
    rng = random.Random(seed)
    rows = [(i, None if rng.random() < 0.05 else DAY + datetime.timedelta(days=0 if rng.random() < hot else rng.randint(-40, 40)), rng.randint(0, 2)) for i in range(n)]
    return rows, spark.createDataFrame(rows, f"{names[0]} int, {names[1]} date, k int")


@pytest.mark.parametrize("back,ahead,rows,hot,keys", [(0, 0, 10**6, 0.0, ()), (3, 5, 10, 0.5, ()), (-2, 6, 7, 0.3, ()), (10, -4, 50, 0.0, ("k",)), (100, 100, 20, 0.0, ("k",))])
def test_near_days_against_all_pairs(spark, back, ahead, rows, hot, keys):
    a, left = dated(spark, 150, ("a", "at"), 1, hot)
    b, right = dated(spark, 120, ("b", "bt"), 2, hot)
    if not keys:
        right = right.withColumnRenamed("k", "k2")
    found = joins.join_near_days(left, right, "at", "bt", back, ahead, keys, rows)
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] and y[1] and -back <= (y[1] - x[1]).days <= ahead and (not keys or x[2] == y[2]))
    assert sorted((r.a, r.b) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_near_days_of_nothing(spark):
    _, left = dated(spark, 5, ("a", "at"), 1)
    right = spark.createDataFrame([], "b int, bt date")
    assert joins.join_near_days(left, right, "at", "bt", 1, 1).collect() == [] and joins.join_near_days(right, left, "bt", "at", 1, 1).collect() == []
    with pytest.raises(ValueError):
        joins.join_near_days(left, right, "at", "bt", -3, 2)


def test_merged_sketches_keep_their_error(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.range(60_000).select((F.col("id") % 30).cast("int").alias("day"), F.when(F.col("id") % 10 > 0, F.expr("pow(xxhash64(id) % 1000 / 1000.0, 3) * 50")).alias("x"))
    sketches.save_sketches(rows, path, ["day"], "x")
    merged = sketches.merged_sketches(sketches.read_sketches(spark, path))
    found = sketches.summaries(merged, {f"q{p}": p / 100 for p in (0, 1, 25, 50, 75, 99, 100)}).first()
    values = sorted(r.x for r in rows.where("x IS NOT NULL").select("x").collect())
    assert (found.rows, found.n, found.low, found.high) == (60_000, len(values), values[0], values[-1])
    import bisect

    for p in (0, 1, 25, 50, 75, 99, 100):
        q = found[f"q{p}"]
        low, high = bisect.bisect_left(values, q) / len(values), bisect.bisect_right(values, q) / len(values)
        assert low - sketches.rank_error() <= p / 100 <= high + sketches.rank_error()
    assert abs(found.distinct - len(set(values))) <= sketches.distinct_error() * len(set(values))


def test_a_repeated_day_replaces_its_own_folder(spark, tmp_path):
    path = str(tmp_path / "s")
    days = spark.createDataFrame([(1, 5.0), (1, 7.0), (2, 9.0), (3, None)], "day int, x double")
    sketches.save_sketches(days, path, ["day"], "x")
    sketches.save_sketches(days.where("day = 1").withColumn("x", F.col("x") * 10), path, ["day"], "x")
    found = sketches.summaries(sketches.merged_sketches(sketches.read_sketches(spark, path), ["day"]), {"top": 1.0}).collect()
    assert {r.day: (r.n, r.low, r.top) for r in found} == {1: (2, 50.0, 70.0), 2: (1, 9.0, 9.0), 3: (0, None, None)}


def test_chunks_from_sql(spark):
    tables.register(spark)
    docs = spark.createDataFrame([(k, " ".join(["word"] * k), f"x{k}") for k in range(0, 400, 40)] + [(900, None, "n")], "id int, body string, more string")
    found = spark.sql("SELECT * FROM chunk_table(TABLE({docs}) PARTITION BY (id), 'body', 300, 20)", docs=docs)
    want = chunking.recursive_chunks(docs, "body", size=300, overlap=20)
    assert found.columns == want.columns and sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(Exception, match="name of its text column"):
        spark.sql("SELECT * FROM chunk_table(TABLE({docs}), 'nothing')", docs=docs).collect()

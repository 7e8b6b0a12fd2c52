import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fascicle.llm import mixing

random.seed(8)
ROWS = [(i, "word " * random.randint(0, 40), random.choice(["a", "a", "a", "b", None]), random.choice(["x", "x", "y", None])) for i in range(400)]
SCHEMA = "doc_id long, text string, source string, lang string"


def brute(rows, powers, keep, rounds):
    """Cell probabilities by plain loops."""
    cells = defaultdict(int)
    for _, t, s, g in rows:
        cells[s, g, "prose"] += len((t or "").split())
    total, w, asked = sum(cells.values()), {c: float(n) for c, n in cells.items()}, []
    for d, p in enumerate(powers):
        sums = defaultdict(float)
        for c, n in cells.items():
            sums[c[d]] += n
        z = sum(v**p for v in sums.values())
        asked.append({k: v**p / z * total for k, v in sums.items()})
    for _ in range(rounds):
        for d in range(3):
            sums = defaultdict(float)
            for c in cells:
                sums[c[d]] += w[c]
            w = {c: w[c] * asked[d][c[d]] / sums[c[d]] if sums[c[d]] else 0.0 for c in cells}
        w = {c: min(w[c], cells[c] / keep) for c in cells}
    return {c: min(1.0, keep * w[c] / n) if n else keep for c, n in cells.items()}, asked, cells


def test_against_plain_loops(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("_w", F.lit("clash")).withColumn("topic", F.lit(1))
    rows = mixing.mixed(df).collect()
    p, _, _ = brute(ROWS, (0.5, 0.7, 0.8), 0.5, mixing.ROUNDS)
    assert len(rows) == len(ROWS)
    assert all(r.probability == pytest.approx(p[r.source, r.lang, r.topic], abs=2e-9) for r in rows)
    kept = sorted(r.doc_id for r in rows if r.kept)
    assert sorted(r.doc_id for r in mixing.sample(df).collect()) == kept
    assert mixing.sample(df).columns == df.columns


def test_marginals_reach_their_targets(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    targets = {"source": spark.createDataFrame([("a", 1.0), ("b", 1.0), (None, 2.0)], "value string, share double")}
    rows = mixing.mixed(df, keep=0.1, rounds=30, targets=targets).collect()
    weight = defaultdict(float)
    for r in rows:
        weight[r.source] += r.probability * r.n_tokens
    total = sum(weight.values())
    assert {k: round(v / total, 4) for k, v in weight.items()} == {"a": 0.25, "b": 0.25, None: 0.5}


def test_odd_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, "", "a", "x"), (2, "", "a", "x"), (None, "w " * 100_000, "a", "x")], SCHEMA)
    rows = mixing.mixed(df).collect()
    assert len(rows) == 4 and len({r.kept for r in rows if r.doc_id == 2}) == 1
    assert all(0 <= r.probability <= 1 for r in rows)
    assert mixing.mixed(df.limit(0)).collect() == [] == mixing.sample(df.limit(0)).collect()


def test_built_in_functions_only(spark):
    plan = mixing.mixed(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

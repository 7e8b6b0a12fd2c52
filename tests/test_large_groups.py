"""Operators on data where one group holds most rows, against brute force."""

import random
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fascicle.operators import aggregates, columns, joins, sampling, windows
from fascicle.operators.windows import Descending


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.8 else f"k{rng.randrange(20)}", i, rng.randrange(50), f"t{i:05d}") for i in range(6000)]
    rows += [(None, 7000 + i, i, f"n{i}") for i in range(5)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, pos int, v int, t string").repartition(6).cache()


def test_running_totals_per_group(skewed):
    got = windows.running_totals(skewed, [F.col("pos")], {"run": F.col("v")}, ["k"]).toPandas()
    want = skewed.toPandas().sort_values("pos")
    want["run"] = want.groupby("k", dropna=False)["v"].cumsum()
    merged = got.merge(want, on="pos", suffixes=("", "_w"))
    assert len(got) == len(want) and (merged["run"] == merged["run_w"]).all()


def test_running_totals_descending(skewed):
    got = windows.running_totals(skewed, [Descending("v"), F.col("pos")], {"run": F.lit(1)}).toPandas().sort_values("run")
    assert list(got["run"]) == list(range(1, len(got) + 1))
    assert list(zip(-got["v"], got["pos"])) == sorted(zip(-got["v"], got["pos"]))


def test_large_group_is_split_over_tasks(skewed):
    laid = skewed.filter("k = 'hot'").repartitionByRange(8, "k", "pos")
    sizes = [r["n"] for r in laid.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 3


@pytest.mark.parametrize("limit", [40, 1000, 10**9])
def test_concat_groups_keeps_everything(skewed, limit):
    df = skewed.withColumn("k", F.expr("nullif(k, 'k3')"))
    got = aggregates.concat_groups(df, "k", "t", "pos", "|", "text", max_chars=limit).fillna("none", ["k"]).toPandas()
    want = defaultdict(list)
    for r in df.orderBy("pos").collect():
        want[r["k"] or "none"].append(r["t"])
    for key, parts in got.sort_values("part").groupby("k"):
        assert "|".join(parts["text"]) == "|".join(want[key])
        assert (parts["text"].str.len() <= limit + 7).all()
        assert list(parts["part"])[0] == 0
    assert set(got["k"]) == set(want)
    if limit == 10**9:
        assert len(got) == len(want)


def test_concat_with_quotes_in_separator(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "k string, o int, t string")
    for sep in ("'", "\\", "\n\n", "\t'"):
        assert aggregates.concat_groups(df, "k", "t", "o", sep).first()["chunk_concat"] == f"x{sep}y"


def test_pareto_ties_and_ranks(spark):
    words = ["a"] * 5 + ["b"] * 5 + ["c"] * 3 + [f"once{i:03d}" for i in range(300)]
    freqs = spark.createDataFrame(list(Counter(words).items()), "string string, frequency bigint")
    got = windows.pareto(freqs).toPandas().sort_values(["frequency", "string"], ascending=[False, True])
    want = got["frequency"].cumsum()
    assert (got["cumulative_sum"] == want).all()
    assert (got["rank"] == got["frequency"].rank(method="min", ascending=False)).all()
    assert abs(got["pareto"].iloc[-1] - 100) < 1e-9 and abs(got["relative_frequency"].sum() - 1) < 1e-9


def test_quantiles_match_pandas(skewed):
    pdf = skewed.toPandas()
    got = windows.exact_quantiles(skewed, "v", {"q1": 0.25, "q2": 0.5, "q9": 0.9}).first()
    for name, p in (("q1", 0.25), ("q2", 0.5), ("q9", 0.9)):
        assert got[name] == pytest.approx(pdf["v"].quantile(p))
    by = windows.exact_quantiles(skewed, "v", {"q": 0.5}, ["k"]).toPandas()
    want = pdf.groupby("k", dropna=False)["v"].median()
    assert sorted(by["q"]) == pytest.approx(sorted(want))


def test_most_frequent_takes_first_seen(spark):
    df = spark.createDataFrame([("g", "x", 3), ("g", "y", 1), ("g", "x", 4), ("g", "y", 9), ("h", "z", 2)], "g string, v string, o int")
    got = {r["g"]: (r["mode"], r["mode_count"]) for r in aggregates.most_frequent(df, "g", "v", F.col("o")).collect()}
    assert got == {"g": ("y", 2), "h": ("z", 1)}


@pytest.mark.parametrize("n", [10, 100, 5000, 10**6])
def test_exact_sample(skewed, n):
    a = sampling.exact_sample(skewed, n, 1337, "pos").toPandas()
    b = sampling.exact_sample(skewed.repartition(3), n, 1337, "pos").toPandas()
    assert len(a) == min(n, skewed.count()) and set(a["pos"]) == set(b["pos"])
    assert set(sampling.exact_sample(skewed, n, 7, "pos").toPandas()["pos"]) != set(a["pos"]) or n >= 6005


@pytest.mark.parametrize("taken", [40, 300])
def test_head_of_a_large_table(skewed, taken):
    want = skewed.toPandas().sort_values(["v", "pos"]).head(taken)
    got = sampling.head(skewed, taken, "v", "pos").toPandas()
    assert list(got["pos"]) == list(want["pos"])
    by_key = sampling.head(skewed, taken, "k", "pos").toPandas()  # NULL keys come first
    assert by_key["k"].isna().sum() == 5 and len(by_key) == taken


def test_balanced_sample(skewed):
    df = skewed.filter("k is not null")
    got = sampling.balanced_sample(df, 42, 1, "k", "pos").toPandas()["k"].value_counts()
    assert len(got) == 21 and (got == 2).all()


def test_balanced_sample_with_large_shares(skewed):
    """Rows without a class are a class; a class that is too small gives all it has."""
    got = sampling.balanced_sample(skewed, 2200, 1, "k", "pos").toPandas()
    rows = skewed.select("k", "pos", F.sha1(F.concat_ws("|", F.lit("1"), F.col("pos").cast("string"))).alias("h")).toPandas()
    classes = rows["k"].nunique(dropna=False)
    share = -(-2200 // classes)
    want = rows.sort_values(["h", "pos"]).groupby("k", dropna=False).head(share)
    assert set(got["pos"]) == set(want["pos"]) and len(got) == len(want)


def test_dense_rank_of_counts(skewed):
    counted = skewed.groupBy("k", "v").agg(F.count("*").alias("n"))
    got = windows.dense_rank_of_counts(counted, "k", "n").toPandas()
    want = got.groupby("k", dropna=False)["n"].rank(method="dense", ascending=False)
    assert len(got) == counted.count() and (got["rank"] == want).all()


def test_numbered_id(spark):
    df = spark.range(1000).select(F.format_string("%05d", F.col("id")).alias("path")).repartition(7)
    got = columns.numbered_id(df, "doc", "path").toPandas().sort_values("path")
    assert list(got["doc"]) == [f"doc{i}" for i in range(1000)]


def test_closest_lookup_matches_brute_force(spark):
    rng = random.Random(3)
    words = lambda n: sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(0, 6))) for _ in range(n)})
    left, right = words(30), words(15)
    l = spark.createDataFrame([(w,) for w in left] + [(None,)], "a string")
    r = spark.createDataFrame([(w, w.upper()) for w in right], "b string, up string")

    def distance(s, t):
        row = list(range(len(t) + 1))
        for i, x in enumerate(s, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(t, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    for limit in (1, 2):
        got = {x["a"]: x["up"] for x in joins.closest_lookup(l, r, "a", "b", ["up"], limit).collect()}
        for w in left:
            near = min(((distance(w, t), t) for t in right if distance(w, t) <= limit), default=None)
            assert got[w] == (near[1].upper() if near else None)
        assert got[None] is None


def test_key_types_must_agree(spark):
    a, b = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([("1",)], "k string")
    with pytest.raises(TypeError):
        joins.left_lookup(a, b, ["k"])


def test_folded_lookup(spark):
    l = spark.createDataFrame([("Été",), ("AILE",), (None,)], "k string")
    r = spark.createDataFrame([("ete", 1), ("aile", 2)], "k string, v int")
    assert {x["k"]: x["v"] for x in joins.folded_lookup(l, r, ["k"]).collect()} == {"Été": None, "AILE": 2, None: None}
    assert {x["k"]: x["v"] for x in joins.folded_lookup(l, r, ["k"], ignore_accents=True).collect()} == {"Été": 1, "AILE": 2, None: None}


def test_binned_counts_folds_rare_categories(spark):
    df = spark.createDataFrame([(float(i % 10), f"c{i % 7}") for i in range(700)] + [(None, "c0"), (3.0, None)], "x double, c string")
    got = aggregates.binned_counts(df, "x", "c", 5, max_colors=3).toPandas()
    assert got["n"].sum() == 701
    assert "Others" in set(got["category"]) and got.groupby("category", dropna=False).size().eq(5).all()


def test_group_aggregates(skewed):
    pdf = skewed.toPandas()
    got = aggregates.grouped_summary(skewed, "k", "v").toPandas().set_index("k")
    want = pdf.groupby("k")["v"]
    assert got.loc["hot", "v_sum2"] == (pdf[pdf.k == "hot"]["v"] ** 2).sum()
    assert got.loc["hot", "v_median"] == want.median()["hot"]
    assert isinstance(got, pd.DataFrame)

import math
import random
from collections import Counter

import pytest

from fascicle.llm import lm_scoring as lm
from fascicle.session import load

random.seed(2)


def test_no_target_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b" * 200_000 + " a")], "doc_id long, text string")
    none = df.select("doc_id").limit(0)
    assert [r.n_tokens for r in lm.score_against(df, none, "doc_id").orderBy("doc_id").collect()] == [3, 2]
    assert lm.score_against(df.limit(0), none, "doc_id").collect() == []


def test_good_documents_look_like_the_target(spark):
    docs, labels = load(spark, "/root/testdata/sf0.01", "documents", "labels")
    rows = lm.score_against(docs, labels.where("quality = 1 AND doc_id % 2 = 0"), "doc_id").join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r.ce_difference for r in rows if r.quality == 1]
    poor = [r.ce_difference for r in rows if r.quality == 0]
    assert sum(g < p for g in good for p in poor) / len(good) / len(poor) > 0.9


def whole(rows, target):
    """Scores over every word, by plain dictionaries."""
    coded = [(d, [None] + (t or "").encode().lower().split()) for d, t in rows]
    v = len({w for _, ws in coded for w in ws[1:]})
    both = [Counter(p for d, ws in coded if keep(d) for p in zip(ws, ws[1:])) for keep in (lambda d: True, lambda d: d in target)]
    scale = sum(both[1].values()) / sum(both[0].values())
    models = [{k: c * scale for k, c in both[0].items()}, dict(both[1])]

    def p(model, h, w):
        single = (sum(c for (_, b), c in model.items() if b == w) + 1) / (sum(model.values()) + v)
        row = [c for (a, _), c in model.items() if a == h]
        return (max(model.get((h, w), 0) - lm.DISCOUNT, 0) + sum(min(c, lm.DISCOUNT) for c in row) * single) / sum(row) if row else single

    return [(d, len(ws) - 1, *[-sum(math.log(p(m, a, b)) for a, b in zip(ws, ws[1:])) / (len(ws) - 1) if ws[1:] else None for m in (models[1], models[0])]) for d, ws in coded]


@pytest.mark.parametrize("block", [40, 1 << 21])
def test_every_word_counts(spark, block):
    """2500 words of equal frequency, all with one ending: a list of the commonest would take most of them as one class."""
    words = [f"w{i}ing" for i in range(2500)]
    rows = [(i, " ".join(words[i * 25 : i * 25 + 25]) + " the " + " ".join(random.choices(words[:40], k=5))) for i in range(100)]
    rows += [(200, None), (201, " "), (None, "The w1ing"), (3, "w1ing w2ing")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int").repartition(3)
    target = spark.createDataFrame([(1,), (3,), (5,), (5,), (None,), (999,)], "doc_id long")
    found = lm.score_against(df, target, "doc_id", block=block).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    found, want = sorted(map(tuple, found), key=key), sorted(whole(rows, {1, 3, 5}), key=key)
    assert len(found) == len(want)
    for f, w in zip(found, want):
        assert f[:2] == w[:2]
        if f[1]:
            assert f[2:4] == pytest.approx(w[2:4], rel=1e-9) and f[4] == pytest.approx(w[2] - w[3], abs=1e-9)
        else:
            assert f[2:] == (None, None, None)

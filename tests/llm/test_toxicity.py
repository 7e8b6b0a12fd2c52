import pytest

from fascicle.llm import toxicity as tx
from fascicle.session import load

LEXICON = tx.Lexicon({" idiot ": 5.0, " moron ": 4.0, " scumb": 3.0}, (" dear idiot ",), (2.0, 0.5, -0.5, -3.0))


def test_folding_undoes_disguise():
    assert tx.folded_words("1d10t Ѕtupіd m0r0n $cum the$$$ ＩＤＩＯＴ i​diot 20 l0$er 3.5") == ["idiot", "stupid", "moron", "scum", "the", "idiot", "idiot", "loser"]
    assert tx.folded_words(None) == [] == tx.folded_words("12 ###")


def test_matches_against_plain_search():
    words = "an idiot and idiots dear idiot scumbag scum moron idiot moron".split()
    text = " " + " ".join(words) + " "
    want = []
    for p, w in LEXICON.patterns.items():
        at = text.find(p)
        while at >= 0:
            covered = any(text.startswith(e, a) and a <= at and at + len(p) <= a + len(e) for e in LEXICON.exceptions for a in range(len(text)))
            want += [] if covered else [(at, at + len(p), w)]
            at = text.find(p, at + 1)
    assert sorted(LEXICON.matches(words)) == sorted(want)


def test_length_weakens_and_matches_strengthen():
    assert LEXICON.score("idiot " + "word " * 10) > LEXICON.score("idiot " + "word " * 5000) > LEXICON.score("word " * 5000)
    assert LEXICON.score("1D1OT and m0ron") == LEXICON.score("idiot and moron") > LEXICON.score("dear idiot and moron")


def test_odd_rows_and_tables(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "idiot", "x"), (3, "idiot", "x"), (None, "word " * 50_000, "x")], "doc_id long, text string, toxic string")
    rows = tx.score(docs, LEXICON, "doc_id").collect()
    scores = {r.doc_id: r.score for r in rows}
    assert len(rows) == 5 and scores[1] == scores[2] < 0.5 < scores[3]
    labels = spark.createDataFrame([(3, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    assert tx.learn(docs, labels.limit(0)).patterns == {}
    assert {r.predicted for r in tx.score(docs, tx.learn(docs, labels), "doc_id").collect()} == {0}
    assert tx.score(docs.limit(0), LEXICON, "doc_id").collect() == []


def test_held_out_labels(spark):
    docs, labels = load(spark, "/root/testdata/sf0.1", "documents", "labels")
    rows = tx.score(docs, tx.learn(docs, labels), "doc_id").withColumn("held_out", tx.held_out()).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == r.toxic == 1 for r in held)
    assert right / sum(r.predicted for r in held) > 0.9 and right / sum(r.toxic for r in held) > 0.85


@pytest.mark.parametrize("a, b", [(10, 0), (5, 5), (0, 3)])
def test_evidence_is_the_g_statistic(a, b):
    import math

    n1, n0 = 20, 30
    cells = [(a, n1), (b, n0), (n1 - a, n1), (n0 - b, n0)]
    hit = [(a + b) / 50, (a + b) / 50, 1 - (a + b) / 50, 1 - (a + b) / 50]
    assert tx.evidence_against(a, b, n1, n0) == pytest.approx(2 * sum(o * math.log(o / (n * h)) for (o, n), h in zip(cells, hit) if o))

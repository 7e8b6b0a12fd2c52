import math
import random
import re
from collections import Counter

import pytest

from fascicle.operators import phrases, sentences, text_index

WORD = re.compile(r"[^\W_]+")


def brute_bm25(docs, queries, k):
    words = {i: WORD.findall((t or "").lower()) for i, t in docs}
    mean = sum(map(len, words.values())) / len(words)
    counts = {i: Counter(w) for i, w in words.items()}
    having = Counter(t for c in counts.values() for t in c)
    out = []
    for q, text in queries:
        scores = Counter()
        for term in set(WORD.findall((text or "").lower())):
            for i, c in counts.items():
                if term in c:
                    norm = text_index.K1 * (1 - text_index.B + text_index.B * len(words[i]) / mean)
                    scores[i] += math.log(1 + (len(docs) - having[term] + 0.5) / (having[term] + 0.5)) * c[term] * (text_index.K1 + 1) / (c[term] + norm)
        best = sorted(((-round(s, 6), i) for i, s in scores.items()))[:k]
        out += [(q, i, -s + 0.0, r) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    random.seed(4)
    rare = [f"word{k}" for k in range(300)]
    docs = [(i, " ".join(["the"] * random.randint(0, 5) + random.choices(rare, k=random.randint(1, 30), weights=[1 / (1 + k) for k in range(300)]))) for i in range(500)]
    return docs + [(900, None), (901, ""), (902, docs[3][1]), (903, docs[3][1]), (904, "the " * 20_000 + "word7")]


@pytest.mark.parametrize("block,k", [(2, 1), (16, 7), (256, 10), (16, 1000)])
def test_word_search_against_all_scores(spark, tmp_path, texts, monkeypatch, block, k):
    monkeypatch.setattr(text_index, "BLOCK", block)
    queries = [(1, "the word1 word250"), (2, "Word3, word3 WORD299!"), (3, "the"), (4, "nothing here is known"), (5, None), (6, texts[3][1]), (7, "word7 the")]
    path = str(tmp_path / "i")
    text_index.build_postings(spark.createDataFrame(texts, "id long, text string"), path, "text", "id")
    found = text_index.search_terms(spark, path, spark.createDataFrame(queries, "query_id long, text string"), k).collect()
    assert sorted(map(tuple, found)) == brute_bm25(texts, queries, k)


def test_bounds_leave_most_postings_unread(spark, tmp_path, texts, monkeypatch):
    monkeypatch.setattr(text_index, "BLOCK", 8)
    path = str(tmp_path / "i")
    text_index.build_postings(spark.createDataFrame(texts, "id long, text string"), path, "text", "id")
    asked = spark.createDataFrame([(1, "the"), (1, "word250")], "query_id long, term string").join(spark.read.parquet(path + "/terms"), "term")
    blocks = text_index._blocks(spark, path, asked)
    _, candidates = text_index._candidates(blocks, asked, 2)
    holders = blocks.where("term = 'the'").selectExpr("sum(size(ids))").first()[0]
    assert candidates.count() < holders / 10
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*folder#\d+ I", plan)


def test_empty_index(spark, tmp_path):
    path = str(tmp_path / "i")
    text_index.build_postings(spark.createDataFrame([], "id long, text string"), path, "text", "id")
    assert text_index.search_terms(spark, path, spark.createDataFrame([(1, "a")], "query_id long, text string"), 3).collect() == []


PROSE = ("Dr. Miller met Prof. Lange in St. Gallen. They spoke for an hour. The talk of Dr. Lange was long! Was it good? It was. "
         "Mr. Frey, Dr. Miller and Prof. Stein left early. It rained. In the U.S. that is rare. Many left. The rest, e.g. Prof. Lange, stayed. They sang. ") * 6


def test_abbreviations_end_no_sentence(spark):
    df = spark.createDataFrame([(1, PROSE), (2, "He saw Dr. Miller. Then he left"), (3, ""), (4, None), (5, "..."), (6, "\"Is it?\" (He asked Prof. Lange.) Yes.")], "id long, text string")
    scores = {r.type: r.score for r in sentences.abbreviation_scores(sentences.period_counts(df, "text")).collect()}
    assert all(scores[a] >= sentences.THRESHOLD for a in ("dr", "prof", "st", "mr", "u.s", "e.g")) and all(scores[w] < sentences.THRESHOLD for w in ("hour", "rained", "early", "was"))
    rows = {}
    for r in sentences.split_sentences(df, "id", "text").collect():
        rows.setdefault(r.id, {})[r.position] = r.sentence
    assert rows[2] == {1: "He saw Dr. Miller.", 2: "Then he left"}
    assert rows[6] == {1: '"Is it?"', 2: "(He asked Prof. Lange.)", 3: "Yes."}
    assert "Dr. Miller met Prof. Lange in St. Gallen." in rows[1].values() and "In the U.S. that is rare." in rows[1].values()
    assert rows[5] == {1: "..."} and 3 not in rows and 4 not in rows
    counts = {r.id: r.sentences for r in sentences.sentence_counts(df, "id", "text").collect()}
    assert counts == {i: len(rows.get(i, ())) for i in range(1, 7)}


def test_a_sentence_may_end_with_an_abbreviation(spark):
    text = "We met Mr. Frey at noon. we met at noon as noon was near noon. " * 10 + "He lives in the U.S. in a house or house. " * 8 + "He left the U.S. We met at noon."
    df = spark.createDataFrame([(1, text)], "id long, text string")
    found = [r.sentence for r in sentences.split_sentences(df, "id", "text").orderBy("position").collect()]
    assert found[-2:] == ["He left the U.S.", "We met at noon."] and "We met Mr. Frey at noon." in found


def brute_c_values(texts, longest=4, least=3):
    counts = Counter()
    for text in texts:
        for piece in re.findall(r"(?:[^\W_]|['\x20\t-])+", (text or "").lower()):
            w = WORD.findall(piece)
            counts.update(" ".join(w[i:i + n]) for n in range(2, longest + 1) for i in range(len(w) - n + 1))
    counts = {p: n for p, n in counts.items() if n >= least}
    out = []
    for p, n in counts.items():
        longer = [m for b, m in counts.items() if b != p and f" {p} " in f" {b} "]
        value = round(math.log2(len(p.split())) * (n - (sum(longer) / len(longer) if longer else 0)), 6)
        if value > 0:
            out.append((p, len(p.split()), n, len(longer), value))
    return sorted(out)


def test_phrases_against_all_pairs(spark):
    random.seed(9)
    words = "central processing unit of the new machine-tool o'clock Été a a".split()
    texts = [" ".join(random.choices(words, k=random.randint(0, 40))) + random.choice([". ", ", b", "\nx", ""]) for _ in range(60)] + [None, "", "the " * 3000]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    assert sorted(map(tuple, phrases.ranked_phrases(df, "text").collect())) == brute_c_values(texts)
    assert phrases.ranked_phrases(df.limit(0), "text").collect() == []

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fascicle.llm import language_id as li
from fascicle.session import load

MODEL = li.Model(("aa", "bb"), (("lorem ipsum dolor sit amet", "ipsum lorem"), ("der hund und die katze", "katze und hund")))


def brute_phrases(symbols, samples, other):
    """Greedy longest phrases of one block by plain substring search."""
    texts = ["".join(map(chr, s)) for s in samples]
    s, n, i = "".join(map(chr, symbols)), 0, 0
    while i < len(s):
        j = i + 1
        while j < len(s) and s[i] != chr(other) and any(s[i : j + 1] in t for t in texts):
            j += 1
        n, i = n + 1, j
    return n


@pytest.mark.parametrize("text", ["ipsum dolor und katze", "zzz qqq", "a", "Lorem IPSUM!! 12 sit. катя", "hund " * 200, ""])
def test_phrases_against_substring_search(text):
    own = li.Parser(MODEL)
    symbols = li.symbols_of(text, own.symbols)
    for k, sample in enumerate(MODEL.samples):
        known = [li.symbols_of(t, own.symbols) for t in sample]
        want = sum(brute_phrases(symbols[i : i + li.BLOCK], known, own.other) for i in range(0, len(symbols), li.BLOCK))
        assert own.phrases([symbols])[0, k] == want


def test_automaton_knows_exactly_the_substrings():
    random.seed(3)
    sequences = [[random.randrange(3) for _ in range(40)] for _ in range(4)]
    table = li.suffix_automaton(sequences, 9)
    inside = {tuple(s[i:j]) for s in sequences for i in range(40) for j in range(i + 1, min(41, i + 8))}
    for n in range(1, 7):
        for code in range(3**n):
            word = tuple(code // 3**k % 3 for k in range(n))
            state = 0
            for c in word:
                state = table[state].get(c, 0)
                if state == 0:
                    break
            assert (state != 0) == (word in inside)


@pytest.mark.parametrize("dense", [1, 2, 126])
def test_listed_and_tabled_transitions_agree(monkeypatch, dense):
    monkeypatch.setattr(li, "DENSE", dense)
    random.seed(4)
    sequences = [[random.randrange(1, 6) for _ in range(60)] for _ in range(3)]
    own = li.Automaton(sequences, 8)
    step = li.suffix_automaton(sequences, 7)
    for state in range(len(step)):
        for c in range(8):
            found = own.after(np.array([state * own.width], np.int32), np.array([c]))[0]
            assert found == step[state].get(c, 0) * own.width
            assert own.start[c] == step[0].get(c, 0) * own.width


def test_many_scripts(spark):
    """Each made-up language takes its letters from another script, two of them from the same."""
    random.seed(14)
    starts = {"en": (0x61, 26), "ru": (0x430, 32), "uk": (0x430, 32), "el": (0x3B1, 24), "he": (0x5D0, 26), "ar": (0x627, 36), "hi": (0x905, 50), "th": (0xE01, 46),
              "ka": (0x10D0, 33), "am": (0x1200, 300), "ko": (0xAC00, 3000), "zh": (0x4E00, 4000), "ja": (0x3041, 80), "hy": (0x561, 38), "ta": (0xB85, 30)}
    rows, words = [], {}
    for lang, (first, count) in starts.items():
        letters = [chr(first + k) for k in range(count) if chr(first + k).isalpha()]
        words[lang] = ["".join(random.choices(letters, k=random.randint(2, 5))) for _ in range(400)]
    for i, lang in enumerate(sorted(starts) * 40):
        rows.append((i, " ".join(random.choices(words[lang], k=60)), lang))
    found = li.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "lang").where(li.held_out()).collect()
    right = {lang: [r.lang_pred == lang for r in found if r.lang == lang] for lang in starts}
    assert all(sum(v) >= 0.95 * len(v) > 0 for v in right.values()), right


def test_more_than_a_hundred_languages(spark):
    random.seed(15)
    words = {f"l{k:03d}": ["".join(random.choices("abcdefghijklmnop", k=6)) for _ in range(30)] for k in range(130)}
    rows = [(i, " ".join(random.choices(words[lang], k=80)), lang) for i, lang in enumerate(sorted(words) * 8)]
    found = li.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "lang").where(li.held_out()).collect()
    assert len({r.lang for r in found}) > 100 and sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)


def test_long_texts_are_parsed_whole(monkeypatch):
    own = li.Parser(MODEL)
    text = "der hund und lorem " * 500
    whole = own.phrases([li.symbols_of(text, own.symbols)])
    monkeypatch.setattr(li, "GROUP", 4 * li.BLOCK)
    assert np.array_equal(own.long(li.symbols_of(text, own.symbols)), whole[0:1])


def test_undetermined_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " 12 !?", None), (4, "katze", "bb"), (4, "katze", None), (None, "lorem ipsum", "aa")], "doc_id long, text string, score string")
    rows = li.predict(docs, MODEL, "doc_id").orderBy("doc_id").collect()
    assert [(r.doc_id, r.lang_pred) for r in rows] == [(None, "aa"), (1, "und"), (2, "und"), (3, "und"), (4, "bb"), (4, "bb")]
    assert all(0 <= r.score <= 1 for r in rows)
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in li.identify(none, "doc_id").collect()} == {"und"}
    assert li.identify(none.limit(0), "doc_id").collect() == []


def test_held_out_accuracy(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    rows = li.identify(docs, "doc_id", "lang").withColumn("held_out", li.held_out()).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    ids = {r.doc_id for r in held}
    for sample in li.train(docs).samples:
        texts = set(sample)
        assert not any(r.text in texts for r in docs.where(F.col("doc_id").isin(sorted(ids)[:50])).collect())

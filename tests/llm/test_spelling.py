import random
import re
import zlib

from fascicle.llm import spelling as sp


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(words, times=sp.TIMES):
    out = {}
    for w, n in words.items():
        mine = [(-m, v) for v, m in words.items() if near(w, v)]
        best = min(mine, default=None)
        out[w] = (n, best[1], -best[0], len(mine)) if best and -best[0] >= times * n else (n, None, None, len(mine))
    rows = []
    for w, (n, form, form_n, count) in out.items():
        root = w
        while out[root][1] is not None:
            root = out[root][1]
        rows.append((w, form, root, n, count, form_n))
    return sorted(rows, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_scan_of_sorted_lists():
    random.seed(1)
    for _ in range(1500):
        letters, size = random.choice(["ab", "abc", "abé", "a😀ÿ"]), random.randint(1, 5)
        words = sorted({"".join(random.choices(letters, k=random.choice([size, size + 1, max(1, size - 1)]))) for _ in range(random.randint(1, 25))})
        lcp = [0] + [sp.shared(words[k - 1], words[k]) for k in range(1, len(words))]
        for q in words:
            assert [words[k] for k in sp.near_in_list(q, words, lcp)] == [w for w in words if near(q, w)], (q, words)


def test_lists_of_any_size_lose_no_pair(spark):
    random.seed(2)
    words = {"".join(random.choices("ab", k=random.randint(7, 9))): random.choice([2, 3, 25, 300, 4000]) for _ in range(700)}
    words |= {"stock" + "".join(random.choices("xyzé", k=random.randint(3, 5))) + "end": random.choice([2, 30]) for _ in range(500)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = brute(words)
    for longest in (1, 30, 10_000):
        assert rows_of(sp.variants(df, longest=longest)) == want


def test_counts_on_odd_rows(spark):
    random.seed(3)
    vocabulary = ["wonderful", "Wonderful", "wonderfull", "ÉTERNELLE", "éternelle", "Straßenbahn", "abcdefg", "abcdef", "x" * 300, "mañana×más÷"]
    rows = [(k, " ".join(random.choices(vocabulary, k=40)) + "1two_three-four.seventh") for k in range(80)]
    rows += [(None, "wonderful " * 50), (7, None), (8, ""), (9, "wonderful" * 20_000)] + rows[:5]
    want = {}
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                want[run] = want.get(run, 0) + 1
    want = {w: n for w, n in want.items() if n >= 2}
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, n int")
    assert rows_of(sp.spelling_variants(df)) == brute(want) and any(r[1] for r in brute(want))


def test_roots_follow_forms(spark):
    words = {"abcdefg": 2, "abcdefh": 40, "abcdeih": 900, "abcjeih": 100_000, "zzzzzzz": 5}
    rows = {r[0]: r for r in rows_of(sp.variants(spark.createDataFrame(list(words.items()), "word string, n long")))}
    assert [rows[w][2] for w in words] == ["abcjeih"] * 4 + ["zzzzzzz"]


def test_empty_table(spark):
    assert sp.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []

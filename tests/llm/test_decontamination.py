import random

import pytest

from fascicle.llm import decontamination as dc

random.seed(5)
WORDS = ["th", "er", "ing", "on", "and", "re", "st", "ble", "ou", "ti", "was", "ha"]


def prose(n):
    return " ".join("".join(random.choices(WORDS, k=random.randint(1, 4))) for _ in range(n))


ITEM = prose(45)
SHORT = prose(14)


def distance_inside(pattern, body):
    """Fewest edits of the pattern against any part of the text, by the full table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for ch in body:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != ch)))
        row, best = new, min(best, new[-1])
    return best


def edited(text, n):
    chars = list(text)
    for _ in range(n):
        at = random.randrange(len(chars))
        chars[at : at + 1] = random.choice([[], ["q"], [chars[at], "z"]])
    return "".join(chars)


def brute(item, body):
    """Whether a region of the item, at any place, is in the text within the budget, by full tables."""
    m = min(dc.REGION, len(item))
    return any(distance_inside(item[s : s + m], body) <= dc.budget(m) for s in range(len(item) - m + 1))


def test_search_against_full_tables():
    items = [(1, dc.normal(ITEM)), (2, dc.normal(SHORT)[:45])]
    index = dc.Index(items)
    hits = set()
    for edits in (0, 1, 3, 6, 10, 14, 18, 24, 40):
        for n, (_, item) in enumerate(items):
            start = random.randrange(max(1, len(item) - 70))
            body = dc.normal(prose(10)) + edited(item[start : start + random.choice([50, 60, 300])], edits) + dc.normal(prose(6))
            found = {row[0]: row for row in index.search(body)}
            for w, (_, pattern) in enumerate(items):
                assert (w in found) == brute(pattern, body), (edits, w)
                hits.add((w, w in found))
                if w in found:
                    _, regions, fewest, covered, first, last = found[w]
                    assert regions >= 1 and fewest <= dc.budget(dc.REGION) and 0 < covered <= 1 and 0 <= first < last <= len(body)
    assert hits == {(0, True), (0, False), (1, True), (1, False)}


def test_every_excerpt_of_a_region_is_found():
    random.seed(21)
    for _ in range(12):
        item = dc.normal(prose(random.randint(25, 60)))
        index = dc.Index([(1, item)])
        before, after = dc.normal(prose(8)), dc.normal(prose(8))
        for start in range(0, len(item) - dc.REGION + 1, 7):
            body = before + item[start : start + dc.REGION] + after
            (_, _, edits, _, first, last), = index.search(body)
            assert edits == 0 and first <= len(before) + 12 and last >= len(before) + dc.REGION - 12
        assert index.search(before + item[: dc.REGION // 2] + after) == []


def test_short_texts_and_places():
    assert dc.Index([]).search("abc" * 50) == []
    text = "A, b! Éß\n_1"
    assert dc.normal(text) == "abéß1" and [text[i] for i in dc.places(text)] == list("AbÉß1")


@pytest.fixture(scope="module")
def found(spark):
    docs = [(1, prose(60) + " " + ITEM + "\n" + prose(10)), (2, prose(200)), (3, None), (4, ""), (5, ITEM.upper().replace(" ", ",\n")), (6, edited(ITEM, 5)),
            (7, " ".join(ITEM.split()[:30])), (8, SHORT), (9, ("filler " * 20_000) + ITEM), (1, ITEM), (None, ITEM), (10, " ".join(ITEM.split()[:6])), (11, prose(20) + " ".join(ITEM.split()[16:30]) + prose(9))]
    df = spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, ITEM), (2, SHORT), (3, None), (4, "tiny"), (None, ITEM), (5, "")], "item_id long, text string")
    return df, items


@pytest.mark.parametrize("block", [dc.BLOCK_ITEMS, 1])
def test_contaminated(found, block):
    df, items = found
    rows = dc.contaminated(df, items, block).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (5, 1), (6, 1), (7, 1), (8, 2), (9, 1), (None, 1), (11, 1)}
    whole = next(r for r in rows if r.doc_id == 9)
    assert whole.edits == 0 and whole.covered == 1.0 and (whole.doc_start, whole.doc_end) == (140_000, 140_000 + len(ITEM))
    assert sorted(r.doc_id for r in dc.clean(df, items, block).collect()) == [2, 3, 4, 10]
    assert dc.clean(df, items).columns == df.columns


def test_empty_tables(found):
    df, items = found
    assert dc.contaminated(df.limit(0), items).collect() == []
    assert dc.contaminated(df, items.limit(0)).collect() == []
    assert dc.clean(df, items.limit(0)).count() == df.count()

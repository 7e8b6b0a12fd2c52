import itertools
import random

import numpy as np
import pytest

from fascicle.llm import jaccard_join as jj
from fascicle.llm.components import connected_components

random.seed(11)
WORDS = [f"w{i}" for i in range(300)]


def shingle_set(text, size=3):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())


def brute(rows):
    """(doc_id, n, component) of every row, by all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
            root[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    best = {r: min((d for d in ds if d is not None), default=None) for r, ds in ids.items()}
    return sorted(((d, len(s), best[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n long")
    return sorted((tuple(r)[:3] for r in jj.similar_groups(df).collect()), key=repr)


def edited(words, n):
    words = list(words)
    for _ in range(n):
        at = random.randrange(len(words))
        words[at : at + 1] = random.choice([[], ["new"], [words[at], "more"]])
    return words


def near_copies(size, length, most):
    base = random.choices(WORDS, k=length)
    return [" ".join(edited(base, random.randint(0, most))) for _ in range(size)]


def rows_of(texts):
    ids = random.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


ODD = [(20_001, None), (20_002, ""), (20_003, " \n\t"), (20_004, "one"), (20_005, "One"), (20_006, "one two"), (20_007, "one two three"), (None, "one two three"),
       (20_008, "ONE two\nthree"), (20_008, "x y z"), (20_009, "é à ü"), (20_010, "É à ü"), (20_011, "a b " * 30_000), (20_012, "a b " * 40_000)]


def test_against_all_pairs(spark):
    texts = [t for k in range(12) for t in near_copies(random.randint(2, 12), random.choice((9, 12, 15, 20, 30, 60, 150, 400)), random.choice((1, 2, 5, 12)))]
    texts += [" ".join(random.choices(WORDS, k=random.randint(1, 80))) for _ in range(60)]
    rows = rows_of(texts) + ODD
    assert found(spark, rows) == brute(rows)


def test_large_group_in_small_tiles(spark, monkeypatch):
    """Far more members than a tile, dense and sparse links, shared passages."""
    monkeypatch.setattr(jj, "TILE", 16)
    monkeypatch.setattr(jj, "NEAREST", 1)
    passage = random.choices(WORDS, k=60)
    texts = near_copies(90, 100, 3) + near_copies(70, 60, 9) + [" ".join(passage + random.choices(WORDS, k=random.randint(1, 20))) for _ in range(60)]
    rows = rows_of(texts)
    assert found(spark, rows) == brute(rows)


def test_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == [(1, 0, 1)]


def test_cells_lose_no_similar_pair():
    """Sets at the limit always share a group in a class."""
    rng = np.random.default_rng(4)
    for n in [*range(9, 60), 100, 333, 1000]:
        for _ in range(4):
            x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            out = rng.integers(0, (len(x) + 9) // 10 + 1)
            kept = np.delete(x, rng.choice(len(x), out, replace=False))
            more = 0
            while 100 * len(kept) >= 90 * (len(x) + more + 1):
                more += 1
            y = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, more, dtype=np.uint64)]))
            common = len(np.intersect1d(x, y))
            if 100 * common >= 90 * (len(x) + len(y) - common):
                assert set(jj.cell_keys(x).tolist()) & set(jj.cell_keys(y).tolist())


@pytest.mark.parametrize("percent", [67, 80, 90])
def test_empty_groups_lose_no_similar_pair(percent):
    """Sets at the limit share a cell, whether both, one or none of them have cells of empty groups."""
    rng = np.random.default_rng(percent)
    for n in [*range(5, 80), 150, 400, 1000]:
        for _ in range(6):
            x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            out = rng.integers(0, jj.differing(n, n, percent) + 1)
            kept = np.delete(x, rng.choice(len(x), min(out, len(x) - 1), replace=False))
            more = len(kept) * 100 // percent - len(x)
            y = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, max(more, 0), dtype=np.uint64)]))
            common = len(np.intersect1d(x, y))
            if 100 * common >= percent * (len(x) + len(y) - common) and len(x) + len(y) > 2 * common:
                assert set(jj.cell_keys(x, percent).tolist()) & set(jj.cell_keys(y, percent).tolist())


def test_unrelated_sets_meet_in_no_cell():
    rng = np.random.default_rng(7)
    keys = [jj.cell_keys(np.unique(rng.integers(0, 1 << 63, 1000 + i, dtype=np.uint64)), 80) for i in range(60)]
    met = np.unique(np.concatenate(keys), return_counts=True)[1]
    assert (met > 1).sum() < 10


@pytest.mark.parametrize("m", [1, 2, 17, 300])
def test_tree_admits_what_the_bound_admits(m):
    rng = np.random.default_rng(m)
    base = rng.integers(0, 6, (m // 3 + 1, jj.GROUPS))
    counts = np.maximum(0, base[rng.integers(0, len(base), m)] + rng.integers(-1, 2, (m, jj.GROUPS)) * (rng.random((m, jj.GROUPS)) < 0.1))
    n, comp = counts.sum(axis=1), rng.integers(0, 4, m)
    i, j = jj.Tree(n, comp, counts).pairs()
    got = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    want = {(a, b) for a in range(m) for b in range(a + 1, m) if comp[a] != comp[b] and 10 * min(n[a], n[b]) >= 9 * max(n[a], n[b])
            and 190 * np.minimum(counts[a], counts[b]).sum() >= 90 * (n[a] + n[b])}
    assert got == want


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(0, 300)] + [(1000 + i, 1000) for i in range(1, 200)] + [(5, 5)]
    random.shuffle(chain)
    rows = connected_components(spark.createDataFrame(chain, "u long, v long")).collect()
    assert {(r.node, r.root) for r in rows} == {(i, 0) for i in range(301)} | {(1000 + i, 1000) for i in range(200)}


@pytest.mark.parametrize("n", [0, 1, 500, 70_000])
def test_points_count_the_groups(n):
    hashes = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
    point = jj.point_of(jj.counts_of(hashes).tobytes())
    assert len(point) == jj.GROUPS and point.sum() == len(hashes)
    assert all(point[g] == sum(int(h) >> 57 == g for h in hashes[:1000]) for g in (0, 5, 127)) or n > 1000


@pytest.mark.parametrize("length, percent", [(5, 80), (2, 67)])
def test_other_shingles_and_similarities(spark, length, percent):
    texts = [t for size in (6, 12, 25, 60, 200) for t in near_copies(8, size, max(2, size // 25))]
    base = random.choices(WORDS, k=100)
    # 16 % more text at the end: similar at 80 per cent, not at 90
    texts += [" ".join(base), " ".join(base + random.choices(WORDS, k=16)), "a b", "a b", "", None]
    rows = rows_of(texts)
    sets = []
    for _, t in rows:
        words = (t or "").split()
        size = min(length, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set())
    root = list(range(len(rows)))
    for _ in rows:
        for i, j in itertools.combinations(range(len(rows)), 2):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[i] = root[j] = min(root[i], root[j])
    want = {d: min(e for (e, _), r in zip(rows, root) if r == own) for (d, _), own in zip(rows, root)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jj.similar_groups(df, length, percent).collect()} == want
    with pytest.raises(ValueError):
        jj.classes_of(100)


def test_pipeline_drops_near_copies_of_four_fifths(spark):
    import corpus_pipeline

    base = random.choices(WORDS, k=100)
    rows = [(1, " ".join(base)), (2, " ".join(base + random.choices(WORDS, k=16))), (3, " ".join(random.choices(WORDS, k=50)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in jj.one_of_each(df).collect()) == [1, 2, 3]
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()) == [1, 3]


@pytest.mark.parametrize("percent", [80, 90])
def test_finer_points_lose_no_similar_pair(percent):
    rng = np.random.default_rng(7)
    admitted = 0
    for n in (400, 513, 700, 3000, 300_000):
        for share in (0.5, 0.7, 0.8, 0.88, 0.9, 0.95, 0.99, 1):
            x = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
            y = np.unique(np.append(x[: int(share * len(x))], rng.integers(0, 1 << 64, len(x) - int(share * len(x)), np.uint64)))
            common = len(np.intersect1d(x, y))
            similar = 100 * common >= percent * (len(x) + len(y) - common)
            may = jj.may_be_similar(jj.fine_of(x), jj.fine_of(y), percent)
            assert may or not similar
            # sets this far apart are told apart unless they are small, or too large for the groups
            if n in (700, 3000) and share == 0.5:
                assert not may
            admitted += may
    assert admitted < 40


def test_large_unrelated_pairs_are_not_verified_on_sets(spark):
    """Only pairs that the finer points admit get whole sets, and the answer stays the same."""
    words = [f"w{i}" for i in range(2000)]
    # half of a text is another one's: their points of few groups are close, the sets are not
    texts = [" ".join(words[:1000]), " ".join(words[:1000] + ["x"]), " ".join(words[:500] + words[1500:]), " ".join(words[1000:])]
    sets = [(bytes([i]), jj.fine_of(jj.shingles(t.encode(), jj.WordHashes(), 3))) for i, t in enumerate(texts)]
    pairs = [(i, j, sets[i][0], sets[j][0], sets[i][1], sets[j][1]) for i, j in itertools.combinations(range(4), 2)]
    rows = spark.createDataFrame(pairs, "a long, b long, dx binary, dy binary, fx binary, fy binary")
    with np.errstate(over="ignore"):
        assert [(r.a, r.b) for r in rows.mapInArrow(jj._close(90), jj.PAIRS).collect()] == [(0, 1)]
    rows = rows_of(texts)
    assert found(spark, rows) == brute(rows)


def test_sets_go_to_python_in_small_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    jj.prepare(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


def test_rounds_keep_only_points_in_cells(spark):
    points = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    cells = spark.createDataFrame([(1, 7), (1, 8), (3, 7)], "id long, cell long")
    assert sorted(r.id for r in jj._met(points, cells).collect()) == [1, 3]

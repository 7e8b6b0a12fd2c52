import hashlib

from fascicle.llm import exact_dedup as ed


def expected(rows):
    norm = [((t or "").translate(str.maketrans("", "", " \t\n\x0b\x0c\r"))) for _, t in rows]
    out = []
    for (doc, _), body in zip(rows, norm):
        group = [(-len(t or ""), d is None, d or 0, d) for (d, t), b in zip(rows, norm) if b == body]
        keep = min(group)[3]
        out.append((doc, keep, len(group), doc == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, sha string")
    return sorted((tuple(r)[:5] for r in ed.exact_duplicates(df, **options).collect()), key=repr)


def test_against_brute_force(spark):
    rows = [(1, "a b"), (2, "ab "), (3, None), (4, ""), (5, " \n"), (6, "a b"), (7, "é à"), (8, "éà"), (None, "ab"), (9, "z" * 100_000), (10, "z" * 100_000 + " ")]
    rows += [(100 + i, "same text") for i in range(500)] + [(1000 + i, f"text {i}") for i in range(300)] + [(5, " \n")]
    assert found(spark, rows) == expected(rows)
    assert found(spark, rows, capacity=8) == expected(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_directory_splits_only_overfull_buckets():
    cells = {0: 10, 1: 10, 2: 1, 3: 1, 4: 0, 5: 0, 6: 3, 7: 0}
    directory = ed.directory_of(cells, 3, 10)
    assert [c for c, _, _ in directory] == list(range(8))
    assert [b for _, b, _ in directory] == [0, 1, 2, 2, 3, 3, 3, 3]
    assert [d for _, _, d in directory] == [3, 3, 2, 2, 1, 1, 1, 1]


def test_colliding_keys_are_chained_by_bytes():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"bucket": [0, 0, 0], "h": [7, 7, 7], "body": [b"x", b"y", b"x"], "sha": ["1", "2", "1"], "n": [1, 1, 2], "chars": [1, 1, 3], "first": [4, 5, 6]})
    rows = [r for b in ed._chains(iter([batch])) for r in b.to_pylist()]
    assert [(r["chain"], r["group_size"], r["keep_id"]) for r in rows] == [(0, 3, 6), (1, 1, 5)]

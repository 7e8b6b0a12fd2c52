"""Steps that grew faster than their input: what is shuffled, stored and handed to Python."""

import datetime
import math

import pyarrow as pa
import pytest

from fascicle.catalog import cases, models
from fascicle.llm import jaccard_join
from fascicle.operators import chunking, joins, phrases, retrieval, sentences, text_index
from fascicle.sources import delimited, files


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_postings_are_stored_once(spark, tmp_path, monkeypatch):
    def refuse(df):
        raise AssertionError("postings are stored on the way")

    monkeypatch.setattr(text_index, "materialise", refuse)
    monkeypatch.setattr(text_index, "BLOCK", 3)
    docs = [(i, "a " * (i % 4 + 1) + ("b" if i % 2 else "c")) for i in range(40)]
    path = str(tmp_path / "i")
    text_index.build_postings(spark.createDataFrame(docs, "id long, text string"), path, "text", "id")
    rows = text_index.read_folders(spark, path + "/blocks").collect()
    assert sum(r.n for r in rows) == 80 and all(len(r.ids) == len(r.weights) == r.n <= 3 and r.top == max(r.weights) for r in rows)
    terms = {r.term: r for r in spark.read.parquet(path + "/terms").collect()}
    assert {t: r.having for t, r in terms.items()} == {"a": 40, "b": 20, "c": 20}
    assert terms["b"].idf == pytest.approx(math.log(1 + 20.5 / 20.5))


def test_blocks_of_a_term_go_on_in_the_next_batch():
    def batch(terms):
        n = len(terms)
        return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(range(n)), pa.array([float(n - i) for i in range(n)]), pa.array([7] * n, pa.int32())], names=["term", "id", "weight", "folder"])

    out = [r for b in text_index._cutter(2)([batch(["a", "b", "b", "b"]), batch(["b", "b", "b"]), batch(["b"]), batch(["b", "c"])]) for r in b.to_pylist()]
    assert [(r["term"], r["before"], r["n"]) for r in out] == [("a", 0, 1), ("b", 0, 2), ("b", 2, 1), ("b", 3, 2), ("b", 5, 1), ("b", 6, 1), ("b", 7, 1), ("c", 0, 1)]


def test_lines_of_a_day_are_joined_once(spark, tmp_path, monkeypatch):
    day = lambda d: datetime.date(2020, 1, d)
    orders = [(1, day(2)), (2, day(9)), (3, None), (None, day(3)), (1, day(2))]
    lines = [(k, day(d)) for d in (1, 3, 4, 9) for k in (1, 2, None)] + [(5, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_linenumber int, l_shipdate date").write.parquet(f"{tmp_path}/lineitem.parquet")
    sizes, join = [], joins.join_near_days

    def counted(left, right, *args, **kw):
        sizes.append(right.filter("shipped is not null").count())
        return join(left, right, *args, **kw)

    monkeypatch.setattr(joins, "join_near_days", counted)
    found = {r.o_orderkey: (r.lines, r.numbers) for r in cases()["lines_shipped_near_orders"].run(spark, str(tmp_path)).collect()}
    assert sizes == [4] and found == {1: (12, 12), 2: (3, 3), None: (6, 6)}


def test_equal_query_vectors_are_scanned_once(spark, monkeypatch):
    index = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(50)], "vec_id long, embedding array<float>")
    asked = spark.createDataFrame([(q, [float(q % 3), 1.0]) for q in (*range(40), 7)], "query_id long, embedding array<float>")
    seen, scan = [], retrieval._scan
    monkeypatch.setattr(retrieval, "_scan", lambda items, shared, *rest: seen.append(len(shared)) or scan(items, shared, *rest))
    rows = retrieval.top_k(index, asked, 4, exclude_self=True).collect()
    assert sum(seen) == 3
    best = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        best.setdefault(r.query_id, []).append(r.id)
    assert best[0] == [7, 14, 21, 28] and best[3] == [0, 7, 14, 21] and best[7] == [1, 1, 8, 8] and len(best) == 40


def test_banks_are_embedded_once(spark, small):
    out, _ = models._answered(spark, small)
    assert "run(text" not in out._jdf.queryExecution().analyzed().toString()


def test_tokens_are_counted_before_they_are_described(spark):
    df = spark.createDataFrame([(1, 'Dr. (Dr.) "Who?" went. he Went')], "id long, text string")
    for found in (sentences.period_counts(df, "text"), sentences.starter_counts(df, "text"), sentences._marks(df, "id", "text")):
        assert "lambda" not in plan(found)
    assert {tuple(r) for r in sentences.period_counts(df, "text").collect()} == {("dr", 2, 2), ("who?", 1, 0), ("went", 2, 1), ("he", 1, 0)}
    assert {tuple(r) for r in sentences.starter_counts(df, "text").collect()} == {("dr", 0, 0), ("who?", 0, 0), ("went", 1, 1), ("he", 1, 0)}


def test_counts_are_computed_once(spark, monkeypatch):
    stored = []
    for module in (sentences, phrases):
        keep = module.materialise
        monkeypatch.setattr(module, "materialise", lambda df, keep=keep: stored.append(1) or keep(df))
    df = spark.createDataFrame([("one two. one two. one two.",)], "text string")
    sentences.abbreviation_scores(sentences.period_counts(df, "text")).collect()
    assert [r.phrase for r in phrases.ranked_phrases(df, "text").collect()] == ["one two"] and len(stored) == 2


def test_chunker_gets_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    chunking.recursive_chunks(spark.createDataFrame([("a",)], "t string"), "t")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000


def test_exported_files_are_compressed_and_bounded(spark, tmp_path):
    df = spark.range(25).coalesce(1).selectExpr("id", "repeat('x, \"', 50) AS t")
    delimited.export_csv(df, str(tmp_path / "e"), rows_per_file=10)
    assert len(list((tmp_path / "e").glob("*.csv.gz"))) == 3
    back = spark.read.schema(df.schema).option("header", "true").option("escape", '"').csv(str(tmp_path / "e"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_files_are_listed_and_read_in_tasks(spark, tmp_path):
    """No scan that gathers every file's status in the driver; written files are spread over subfolders."""
    folder = str(tmp_path / "out")
    df = spark.createDataFrame([(f"n{i}", f"text {i}" if i % 7 else None) for i in range(60)], "n string, t string")
    written = {r["path"]: r["size"] for r in files.write_one_file_per_row(df, folder, "n", "t", folders=4).collect()}
    assert {p.split("/")[0] for p in written} == {"0000", "0001", "0002", "0003"}
    for hidden in (".h.md", "_h.md", "_h/x.md", "_a=1/x.md"):
        (tmp_path / "out" / hidden).parent.mkdir(exist_ok=True)
        (tmp_path / "out" / hidden).write_text("hidden?")
    (tmp_path / "out" / "packed.md.gz").write_bytes(b"\x1f\x8bno")
    texts = files.read_texts(spark, folder, "*.{md,gz}")
    assert "binaryFile" not in texts._jdf.queryExecution().executedPlan().toString()
    rows = {r["path"]: (r["text"], r["error"]) for r in texts.collect()}
    assert rows.pop("/_a=1/x.md") == ("hidden?", None) and rows.pop("/packed.md.gz")[1] == "not UTF-8"
    assert {p: t for p, (t, _) in rows.items()} == {f"/{p}": f"text {i}" if i % 7 else "" for p in written for i in [int(p.split("/n")[1][:-3])]}


def test_cells_are_dealt_once(spark, monkeypatch):
    kept, stored = [], jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, label: kept.append(df) or stored(df, label))
    rows = [(i, 10, b"", [i % 5, 100 + i % 3, 1000 + i]) for i in range(60)]
    points = spark.createDataFrame(rows, "id long, n long, counts binary, keys array<long>")
    jaccard_join._members(points)
    assert len(kept[0].collect()) > 0
    assert "ReusedExchange" in kept[0]._jdf.queryExecution().executedPlan().toString()

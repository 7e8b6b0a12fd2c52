"""The pipeline's rows against the same decisions made in plain Python."""

import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_decontamination import ITEM
from test_jaccard_join import near_copies, shingle_set
from tokenizers import Tokenizer

import corpus_pipeline
from fascicle.llm import decontamination, language_id, mixing
from fascicle.session import load


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    docs = load(spark, "/root/testdata/sf0.001", "documents").collect()
    rows = [tuple(r) for r in docs]
    extra = near_copies(6, 40, 1) + ["", None, "12 34", docs[0].text, "before " + ITEM + " after", docs[3].text]
    rows += [(50_000 + i, t, "en" if i % 2 else None, "src0", len(t or "")) for i, t in enumerate(extra)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_return_the_columns_of_documents(spark, folder):
    docs = load(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert stage(spark, docs.limit(0), folder).collect() == []
        assert "extra" in stage(spark, docs.selectExpr("*", "1 AS extra"), folder).columns


def test_rows_against_plain_python(spark, folder):
    docs = load(spark, folder, "documents")
    model = language_id.Parser(language_id.train(docs))
    rows = [r for r in docs.collect() if model.predict([r.text])[0][0] != "und"]
    sets = {r.doc_id: shingle_set(r.text, 5) for r in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    rows = [r for r in rows if find(r.doc_id) == r.doc_id]
    index = decontamination.Index([(1, decontamination.normal(ITEM))])
    rows = [r for r in rows if not index.search(decontamination.normal(r.text))]
    filled = [(r.doc_id, r.text, r.lang or model.predict([r.text])[0][0], r.source, r.n_chars) for r in rows]
    kept = {r.doc_id for r in mixing.mixed(spark.createDataFrame(filled, docs.schema)).where("kept").collect()}
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for r in sorted((r for r in rows if r.doc_id in kept), key=lambda r: r.doc_id):
        ids = [*whole.encode(r.text, add_special_tokens=False).ids, 2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    found = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, found.collect())) == want and 0 < len(want) < len(filled)


def test_nothing_is_dropped_for_missing_labels(spark, folder):
    docs = load(spark, folder, "documents").withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, docs, folder)
    assert kept.dtypes == docs.dtypes
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or ""))

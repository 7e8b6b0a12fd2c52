"""Chunker, dictionary, sentence and tagger jobs."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fascicle.operators import chunking, corpus, joins
from fascicle.operators.chunking import split_spans
from fascicle.plans import documents

texts = st.text(alphabet="ab \n\té", max_size=400)


@settings(max_examples=300, deadline=None)
@given(texts, st.integers(5, 60), st.integers(0, 30))
def test_chunk_properties(text, size, overlap):
    overlap = min(overlap, size - 1)
    spans = split_spans(text, size, overlap)
    covered = set()
    for a, b in spans:
        assert 0 < b - a <= size and text[a:b] == text[a:b].strip()
        covered.update(range(a, b))
    assert all(c.isspace() for i, c in enumerate(text) if i not in covered)
    for (a1, b1), (a2, b2) in zip(spans, spans[1:]):
        assert a2 >= a1 and b2 > b1 and b1 - a2 <= overlap


def plain_chunks(text, size, overlap, separators=("\n\n", "\n", " ", "")):
    """The same rules on strings: split, gather, try every tail for the overlap."""
    def pieces(part, seps):
        if not seps[0]:
            return list(part)
        cut = part.split(seps[0])
        out = []
        for p in [cut[0], *(seps[0] + c for c in cut[1:])]:
            out += [p] if len(p) <= size else [None, *pieces(p, seps[1:]), None]
        return [p for p in out if p != ""]

    out, held, at = [], [], 0  # held: pieces; at: where the next one starts

    def close():
        body = "".join(held)
        start = at - len(body) + len(body) - len(body.lstrip())
        if body.strip() and not (out and start + len(body.strip()) <= out[-1][1]):
            out.append((start, start + len(body.strip())))

    for p in pieces(text, separators):
        if p is None:
            close()
            held = []
            continue
        if held and len("".join(held)) + len(p) > size:
            close()
            tails = [held[k:] for k in range(len(held) + 1)]
            held = next(t for t in tails if len("".join(t)) <= overlap and len("".join(t)) + len(p) <= size)
        held = [*held, p]
        at += len(p)
    close()
    return [text[a:b] for a, b in out]


@settings(max_examples=500, deadline=None)
@given(texts, st.integers(5, 60), st.integers(0, 30))
def test_chunks_against_plain_strings(text, size, overlap):
    overlap = min(overlap, size - 1)
    assert [text[a:b] for a, b in split_spans(text, size, overlap)] == plain_chunks(text, size, overlap)


def test_chunk_queries_on_real_texts(spark, small):
    from fascicle.catalog import cases
    from fascicle.session import load

    docs = {r.doc_id: r.text for r in load(spark, small, "documents").collect()}
    found = {}
    for r in cases()["recursive_chunks"].run(spark, small).collect():
        found.setdefault(r.doc_id, {})[r.chunk_id] = r.chunk
    assert found == {d: dict(enumerate(plain_chunks(t, 3000, 120))) for d, t in docs.items() if t and t.strip()}
    assert any("\n\n" in t for t in docs.values()) or any("\n" in t for t in docs.values())
    texts_ = {r.doc_id: ("E " if r.lang == "en" else "") + r.text for r in load(spark, small, "documents").collect()}
    wanted = {f"d{d}_page_0001.pdf {k}": f"{c}\n\n*ATA* (llm annotation): {str(d)[0]}" for d, t in texts_.items() for k, c in enumerate(plain_chunks(t, 3000, 120))}
    rows = {r.chunk_id: r.chunk for r in cases()["document_ingest"].run(spark, small).collect()}
    assert rows == {i: c for i, c in wanted.items() if len(c) > 200}


def test_chunks_prefer_paragraphs_and_lines():
    text = "aaa bbb\n\nccc ddd\neee fff"
    assert [text[a:b] for a, b in split_spans(text, 16, 0)] == ["aaa bbb", "ccc ddd", "eee fff"]
    assert [text[a:b] for a, b in split_spans(text, 17, 0)] == ["aaa bbb", "ccc ddd\neee fff"]
    assert [text[a:b] for a, b in split_spans(text, 100, 0)] == [text]
    assert [b - a for a, b in split_spans("x" * 25, 10, 0)] == [10, 10, 5]
    assert split_spans("", 10, 0) == [] and split_spans(" \n ", 10, 0) == []


def test_overlap_repeats_the_tail():
    text = "one two three four five six"
    chunks = [text[a:b] for a, b in split_spans(text, 14, 6)]
    assert chunks[0] == "one two three" and chunks[1].startswith("three")


def test_recursive_chunks_frame(spark):
    df = spark.createDataFrame([("a", "x" * 7000, 1), ("b", "", 2), ("c", None, 3), ("d", "é 𝒳 " * 2000, 4)], "doc string, text string, n int")
    got = chunking.recursive_chunks(df, "text").toPandas()
    assert got.columns.tolist() == ["doc", "n", "chunk_id", "chunk"] and set(got["doc"]) == {"a", "d"}
    assert got["chunk"].str.len().max() <= 3000
    assert got[got.doc == "d"]["chunk"].iloc[0].startswith("é 𝒳 é")


def test_annotations_and_finish(spark):
    notes = ["- ATA: 52\n- Parts: None\n- Type: figure", "- ATA: None\n- Parts: rib, frame", None]
    df = spark.createDataFrame([(f"/d{i}.pdf", i, n, "body\nthe Stamp line\nend") for i, n in enumerate(notes)], "doc string, chunk_id int, note string, chunk string")
    out = chunking.finish_chunks(chunking.annotations(df, "note", documents.ANNOTATION_COLUMNS), "Stamp").orderBy("doc").collect()
    assert out[0]["chunk_id"] == "d0.pdf 0" and out[0]["doc"] == "d0.pdf" and out[0]["doc_type"] == "figure"
    assert out[0]["chunk"] == "body\n\nend\n\n*ATA* (llm annotation): 52"
    assert out[1]["chunk"].endswith("*Parts* (llm annotation): rib, frame\n") and out[1]["doc_type"] is None
    assert out[2]["length"] == len(out[2]["chunk"]) == len("body\n\nend")


def test_document_flow(spark):
    files = [("x_page_0001.pdf", None), ("x_page_0001.md", "plain " * 100), ("x_page_0001__with_img_desc.md", "rich " * 100),
             ("x_page_0001-img-3.jpeg", None), ("x_page_0001-img-3.md", "three"), ("x_page_0001-img-12.jpeg", None),
             ("y.PDF", None), ("y.md", "only " * 100), ("y__with_img_desc.md", "  "), ("z.md", "no page")]
    pages = joins.assemble_pages(spark.createDataFrame(files, "path string, text string"))
    rows = {r["doc"]: r for r in pages.collect()}
    assert set(rows) == {"x_page_0001.pdf", "y.PDF"}
    x, y = rows["x_page_0001.pdf"], rows["y.PDF"]
    assert x["doc_root"] == "x.pdf" and x["md_img"].startswith("rich") and x["img-3"] == "x_page_0001-img-3.jpeg" and x["img-3-desc"] == "three"
    assert y["md_img"].startswith("only") and y["img-0"] is None and len(pages.columns) == 25
    assert [(im["k"], im["path"], im["desc"]) for im in x["images"]] == [(3, "x_page_0001-img-3.jpeg", "three"), (12, "x_page_0001-img-12.jpeg", None)] and y["images"] == []
    chunks = documents.prepare_chunks(pages.withColumn("llm_output", F.lit("- ATA: 1\n- Parts: None\n- Type: text")))
    assert set(chunks.columns) == {"doc", "doc_root", "json", "ATA", "parts", "doc_type", "chunk_id", "chunk", "length"}
    assert documents.filter_chunks(chunks, [("doc_type", "text")]).count() == 0
    assert documents.filter_chunks(chunks, [("doc_type", "figure")]).count() == 2


def test_differs_keeps_missing_values(spark):
    df = spark.createDataFrame([("a", 300), (None, 300), ("b", 300), ("b", 200)], "t string, length int")
    assert documents.filter_chunks(df, [("t", "a")]).count() == 2


def test_dictionaries(spark):
    repeated = "Foreword \nmore\nabeam abeam / at a right an-\ngle to \nit. Aile Aile / une été\n9 Zoé  Zoé / last \n"
    line = "Foreword\nabort \nTo stop.\nélan \nVigour\nand more.\nend \n"
    df = spark.createDataFrame([("r", repeated), ("l", line), ("none", "nothing here"), (None, None)], "f string, t string")

    def entries(rows):
        return [(r["entry"], r["definition"]) for r in rows.collect()]

    assert entries(corpus.repeated_headword_entries(df.filter("f = 'r'"), "f", "t")) == [
        ("abeam", "/ at a right angle to it."), ("Aile", "/ une été\n9"), ("Zoé", "/ last")]
    assert entries(corpus.line_headword_entries(df.filter("f = 'l'"), "f", "t")) == [
        ("abort", "/To stop."), ("élan", "/Vigour\nand more."), ("end", "/")]
    assert entries(corpus.line_headword_entries(df.filter("f = 'none' OR f IS NULL"), "f", "t")) == []


def test_sentences(spark):
    df = spark.createDataFrame([("A first\none. A second!\n\nA heading\n\nLast? yes",), ("A first one.",)], "t string")
    assert {r["sentence"] for r in corpus.sentence_table(df, "t").collect()} == {"A first one.", "A second!", "Last?"}
    tagged = corpus.sentence_table(df, "t", lambda s: (s.contains("second"), F.lit(True)))
    assert {r["sentence"] for r in tagged.collect()} == {"A second!"}


def test_profile_matches_python(spark):
    texts = ["Zwei alte Wörter, zwei neue.\nEnde!", "a", "", "b a  b\n\nc"]
    df = spark.createDataFrame(list(enumerate(texts)), "d int, t string")
    for r in corpus.document_profile(df, "d", "t").collect():
        t = texts[r["d"]]
        w = t.split()
        assert r["num_chars"] == len(t) and r["num_words"] == len(w) and r["num_paragraphs"] == t.count("\n") + 1
        assert r["num_uppercase"] == sum(c.isupper() for c in t) and r["num_lowercase"] == sum(c.islower() for c in t)
        assert r["num_punctuation"] == sum(c in ".,;:!?" for c in t) and r["num_unique_words"] == len(set(w))
        assert r["longest_word"] == (max(w, key=len) if w else "") and r["shortest_word"] == (min(w, key=len) if w else "")
        assert r["most_common_word"] == (max(w, key=w.count) if w else "")
        assert abs(r["avg_word_length"] - (sum(map(len, w)) / len(w) if w else 0)) < 1e-9


def test_stable_nouns_need_all_three_forms(spark):
    def tagger(batch):
        return batch.map(lambda t: [(w, "NNP" if w[0].isupper() else "NN" if w != "run" else "VB") for w in t.split()])

    df = spark.createDataFrame([("d", "Run rotor Rotor run")], "d string, t string")
    got = corpus.stable_nouns(df, "d", "t", tagger)
    assert {(r["word"], r["string"]) for r in got.collect()} == {("rotor", "rotor"), ("Rotor", "rotor")}
    freq = corpus.noun_frequencies(got).collect()
    assert [(r["string"], r["frequency"]) for r in freq] == [("rotor", 2)]


def test_entities_and_phrases(spark):
    df = spark.createDataFrame([("d", "Rear Spar web, call A1 or b2")], "d string, t string")
    assert [(r["entity"], r["label"]) for r in corpus.entities(df, "d", "t", [("CODE", "[A-Z][0-9]"), ("LOW", "[a-z][0-9]")]).collect()] == [("A1", "CODE"), ("b2", "LOW")]
    assert corpus.phrase_lists(df, "d", "t").first()["phrases"] == ["Rear Spar"]
    hooked = corpus.phrase_lists(df, "d", "t", lambda s: s.map(lambda t: t.split(", ")))
    assert hooked.first()["phrases"] == ["Rear Spar web", "call A1 or b2"]
    assert corpus.extracted(df, "d", "t", lambda s: s.map(lambda t: [(t[:4], "X")])).first()["entity"] == "Rear"


def test_answered_requests_are_the_models_answers(spark, small):
    import json
    import re as regex

    from fascicle.catalog import cases, models
    from fascicle.operators import prompts

    rows = cases()["answered_requests"].run(spark, small).collect()
    assert rows and sum(r.search_docs.startswith('[{') for r in rows) > len(rows) / 3
    for r in rows:
        values = {"description": r.input_description, **r.asDict()}
        answer = json.loads(prompts.offline_model("", regex.sub(r"{{(\w+)}}", lambda m: values[m[1]], models.PROPOSE)))
        assert (r.label, r.comment) == (answer["label"], answer["comment"])

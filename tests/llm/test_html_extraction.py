import itertools
import random

import pytest

from fascicle.llm import html_extraction as hx
from fascicle.session import load


def test_blocks():
    page = """<!DOCTYPE html><head><title>T</title><style>p{}</style><script>var t="</p>";</script><body><nav><ul><li><a href=x>Home</a><li>About &amp; more</ul></nav>
    <!-- note --><div class="post mainText" id=c1><h1>Head\n line</h1><p>One <b>two</b>&nbsp;x<br>three<p>Next &lt;b&gt; &eacute;<textarea>no</textarea><table><tr><td>a<td>b</table></div><p hidden>zz"""
    blocks = hx.blocks_of(page)
    assert [b.text for b in blocks] == ["Home", "About & more", "Head line", "One two x three", "Next <b> é", "a", "b", "zz"]
    assert blocks[0].tags[-3:] == ("nav", "ul", "li") and blocks[0].link == 4
    assert {w for ws in blocks[3].names for w in ws} == {"post", "main", "text", "c"}
    assert "hidden" in blocks[-1].names[-1]


@pytest.mark.parametrize("page", [None, "", " \n", "plain text", "<", "<!", "<![CDATA[x", "<!DOCTYPE", "&#xFFFFFFF; &bogus;", "</div></p>", "<p" * 500, "<div>" * 3000 + "x", "<script>never closed <p>x", "\x00<p>a\x00b"])
def test_broken_pages(page):
    hx.Field().extract(page)
    assert all(b.text for b in hx.blocks_of(page))


def test_field_against_all_labellings():
    random.seed(1)
    field = hx.Field()
    field.moves = [[0.4, -0.3], [-0.7, 0.9]]
    scores = [random.uniform(-2, 2) for _ in range(7)]

    def value(y):
        return sum(s for s, a in zip(scores, y) if a) + sum(field.moves[a][b] for a, b in zip(y, y[1:]))

    import math

    every = list(itertools.product((0, 1), repeat=7))
    assert field.decode(scores) == list(max(every, key=value))
    z = sum(math.exp(value(y)) for y in every)
    main, moves = field.expectations(scores)
    for i in range(7):
        assert main[i] == pytest.approx(sum(math.exp(value(y)) for y in every if y[i]) / z)
    for a, b in itertools.product((0, 1), repeat=2):
        assert moves[a][b] == pytest.approx(sum(math.exp(value(y)) * sum((p, q) == (a, b) for p, q in zip(y, y[1:])) for y in every) / z)
    assert field.decode([]) == []


def article(page):
    blocks = hx.blocks_of(page)
    return "\n\n".join(b.text for b, y in zip(blocks, hx.semantic_labels(blocks)) if y)


def test_pages_not_trained_on(spark):
    pages = load(spark, "/root/testdata/sf0.1", "pages")
    field = hx.train(pages.where("page_id % 2 = 0"))
    rows = hx.extract(pages.where("page_id % 2 = 1"), field, "html").collect()
    assert sum(r.text == article(r.html) for r in rows) / len(rows) > 0.99
    assert all(r.n_chars == len(r.text) for r in rows)


def test_layouts_not_trained_on(spark):
    pages = [r.html for r in load(spark, "/root/testdata/sf0.01", "pages").collect()]
    field = hx.Field().fit(hx.labelled_pages(pages[:100]))
    right = total = 0
    for k, page in enumerate(pages[100:200]):
        blocks = hx.blocks_of(page)
        main = [b.text for b, y in zip(blocks, hx.semantic_labels(blocks)) if y]
        made, truth = hx.made_up(main[0], main[1:], ["We use cookies on this site.", "Great article, thanks!", "Subscribe to our letter now."], random.Random(k))
        found = hx.blocks_of(made)
        labels = field.decode(field.scores(hx.features(found)))
        right += sum(a == b for a, (_, b) in zip(labels, truth))
        total += len(truth)
    assert right / total > 0.97


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (2, None, "<article><p>Some text here, long enough.</p></article>", "x"), (None, "u", "<p>" + "word " * 100_000, "x")], "page_id long, url string, html string, text string")
    rows = hx.extract_main_text(pages, "page_id", "url").collect()
    assert len(rows) == 4 and [r.n_chars for r in rows if r.page_id == 1] == [0]
    assert hx.extract_main_text(pages.limit(0), "page_id").collect() == []


@pytest.mark.parametrize("section", ["<![x y]>", "<![ if gte mso 9]>", "<![]>", "<![x[ y ]]>", "<![1]>", "<![if x]>"])
def test_text_after_an_unknown_section_stays(section):
    page = f"<article><p>one</p>{section}<p>two</p><p>three</p></article>"
    assert [b.text for b in hx.blocks_of(page)][0] == "one"
    assert [b.text for b in hx.blocks_of(page)][-2:] == ["two", "three"]
    assert "two" in " ".join(b.text for b in hx.blocks_of(f"<p>one</p><p>two</p><p>x {section[:-1]}"))


def test_blocks_are_joined_by_an_empty_line(spark):
    pages = load(spark, "/root/testdata/sf0.01", "pages")
    page = """<html><head><title>T</title></head><body><nav><a href="/">Home</a> <a href="/n">News</a></nav><article><h1>A longer heading of it</h1>
      <p>First   paragraph with &amp; sign, long enough to be read.</p><p>Second paragraph,
      also long enough to be read by anyone.</p></article><footer>All rights reserved</footer></body></html>"""
    field = hx.train(pages)
    assert field.extract(page) == "A longer heading of it\n\nFirst paragraph with & sign, long enough to be read.\n\nSecond paragraph, also long enough to be read by anyone."


@pytest.mark.parametrize("tag", ["svg", "select", "button"])
def test_unclosed_silent_tags_end_at_the_next_paragraph(tag):
    assert [b.text for b in hx.blocks_of(f"<p>a</p><{tag}>x<p>b</p><h2>c</h2><p>d</p>")] == ["a", "b", "c", "d"]
    assert [b.text for b in hx.blocks_of(f"<p>a</p><{tag}><i>x</i></{tag}><p>b</p>")] == ["a", "b"]

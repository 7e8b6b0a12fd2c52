"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, each with its ancestors'
tags, class and id words. Features of the ancestors and of the text score a block as main text or
not, transitions tie neighbours together, and Viterbi decoding labels the page.

The field is trained on labelled pages. Labels come from a bounded, hash-picked sample of the pages
at hand that mark their article with semantic tags; every such page is also laid out anew a few
times with the same text and other markup (plain containers with class names, side columns,
notices, forms, reader comments), so that the field learns more than one template. Training is by
stochastic gradient with exact forward-backward expectations.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

SAMPLE = 150
LAYOUTS = 8
EPOCHS = 10
RATE = 0.3
# Characters of a sampled page that are used for training.
SAMPLE_CHARS = 60_000

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg math head title iframe object canvas audio video map select option textarea button".split())
# Silent tags that hold no tag of text; one left open ends there.
NO_BLOCKS = frozenset("svg math select option button".split())
TEXT_TAGS = frozenset("article blockquote dl h1 h2 h3 h4 h5 h6 main ol p section table ul".split())
# An opening tag that ends an open one of these, up to the nearest of the bounds.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
BLOCKS_CLOSE_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
BOUNDS = frozenset("ul ol table div article section main body td th aside nav header footer form blockquote dl".split())

MAIN_TAGS = frozenset(("article", "main"))
OTHER_TAGS = frozenset("nav aside footer form header dialog menu".split())
# Words in class names and ids that mark what is not main text in a page used for training.
OTHER_NAMES = frozenset("ad ads advert advertisement sponsored promo banner cookie consent notice sidebar menu nav navigation breadcrumb breadcrumbs footer comment comments share related newsletter subscribe popup".split())
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SHORT_WORDS = 8


class Block:
    __slots__ = ("text", "tags", "names", "link", "raw")

    def __init__(self, text: str, tags: tuple[str, ...], names: tuple[tuple[str, ...], ...], link: int, raw: int):
        self.text, self.tags, self.names, self.link, self.raw = text, tags, names, link, raw


class Blocks(HTMLParser):
    """Leaf blocks of a page in page order; unclosed and stray tags are tolerated."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.silent = 0
        self.found: list[Block] = []
        self.held: list[str] = []
        self.link = 0

    def flush(self) -> None:
        raw = "".join(self.held)
        text = " ".join(raw.split())
        if text:
            path = [x for x in self.open if x[0] not in INLINE]
            self.found.append(Block(text, tuple(t for t, _ in path), tuple(n for _, n in self.open), self.link, len(raw)))
        self.held, self.link = [], 0

    def _pop(self, at: int) -> None:
        for tag, _ in self.open[at:]:
            self.silent -= tag in SILENT
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br":
                self.held.append(" ")
            elif tag not in INLINE:
                self.flush()
            return
        if tag not in INLINE:
            self.flush()
            closes = CLOSES.get(tag, ()) + (("p",) if tag in BLOCKS_CLOSE_P else ())
            if self.silent:
                self._end_unclosed(tag)
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] in closes:
                    self._pop(at)
                    break
                if self.open[at][0] in BOUNDS and not (tag in ("td", "th", "tr") and self.open[at][0] in ("td", "th")):
                    break
        names = [w.lower() for k, v in attrs if k in ("class", "id", "role") and v for w in NAME.findall(v)]
        names += ["hidden" for k, v in attrs if k == "hidden" or k == "style" and v and "display:none" in v.replace(" ", "")]
        self.open.append((tag, tuple(names)))
        self.silent += tag in SILENT

    def _end_unclosed(self, tag: str) -> None:
        """A block tag ends a head, and a tag of text ends a drawing, list of choices or button, that was left open."""
        for at, (name, _) in enumerate(self.open):
            if name == "head" and tag in ("body", "article", "main", "div", "p", "nav") or name in NO_BLOCKS and tag in TEXT_TAGS:
                self._pop(at)
                return

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        elif tag not in INLINE:
            self.flush()

    def handle_endtag(self, tag):
        if tag == "br":
            self.held.append(" ")
            return
        if tag not in INLINE:
            self.flush()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._pop(at)
                break
            if tag in INLINE and self.open[at][0] not in INLINE:
                break

    def parse_marked_section(self, i, report=1):
        """A section without a known name is a comment up to the next >."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def handle_data(self, data):
        if self.silent:
            return
        self.held.append(data)
        if any(tag == "a" for tag, _ in self.open):
            self.link += len(data)


def blocks_of(page: str | None) -> list[Block]:
    parser = Blocks()
    parser.feed(page or "")
    parser.close()
    parser.flush()
    return parser.found


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that hold for each block."""
    out, n = [], len(blocks)
    for i, b in enumerate(blocks):
        words = b.text.split()
        f = [f"last={b.tags[-1] if b.tags else ''}", f"two={'/'.join(b.tags[-2:])}"]
        f += [f"tag={t}" for t in set(b.tags)]
        names = {w for ws in b.names for w in ws}
        f += [f"name={w}" for w in names] or ["nameless"]
        f += [f"own={w}" for w in (b.names[-1] if b.names else ())]
        f.append(f"size={min(9, int(math.log2(len(b.text) + 1)))}")
        f.append(f"link={int(4 * b.link / max(1, b.raw))}")
        f.append(f"end={b.text[-1] if b.text[-1] in '.!?:|' else ''}")
        f.append(f"commas={min(3, b.text.count(','))}")
        f.append(f"place={min(4, 5 * i // n)}")
        if "©" in b.text or "(c)" in b.text.lower():
            f.append("copyright")
        if len(words) <= SHORT_WORDS:
            f.append("short")
        letters = [c for c in b.text if c.isalpha()]
        if letters and sum(c.isupper() for c in letters) > 0.6 * len(letters):
            f.append("capitals")
        out.append(f)
    return out


class Field:
    """Weights by feature for main text (against other), transitions between the two labels."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.moves = [[0.0, 0.0], [0.0, 0.0]]

    def scores(self, found: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in fs) for fs in found]

    def decode(self, scores: list[float]) -> list[int]:
        """Viterbi: the best labels of a page."""
        m, back, best = self.moves, [], (0.0, 0.0)
        for i, s in enumerate(scores):
            if i == 0:
                best = (0.0, s)
                continue
            zero = (best[0] + m[0][0], best[1] + m[1][0])
            one = (best[0] + m[0][1], best[1] + m[1][1])
            back.append((int(zero[1] > zero[0]), int(one[1] > one[0])))
            best = (max(zero), max(one) + s)
        if not scores:
            return []
        labels = [int(best[1] > best[0])]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def expectations(self, scores: list[float]) -> tuple[list[float], list[list[float]]]:
        """Forward-backward: probability of main text by block, expected moves."""
        n, m = len(scores), [[math.exp(x) for x in row] for row in self.moves]
        emit = [(1.0, math.exp(max(-30.0, min(30.0, s)))) for s in scores]
        forward = []
        for i, e in enumerate(emit):
            a = e if i == 0 else tuple((forward[-1][0] * m[0][y] + forward[-1][1] * m[1][y]) * e[y] for y in (0, 1))
            z = a[0] + a[1]
            forward.append((a[0] / z, a[1] / z))
        backward, moves = [(1.0, 1.0)] * n, [[0.0, 0.0], [0.0, 0.0]]
        for i in range(n - 2, -1, -1):
            e, b = emit[i + 1], backward[i + 1]
            v = [m[x][0] * e[0] * b[0] + m[x][1] * e[1] * b[1] for x in (0, 1)]
            z = forward[i][0] * v[0] + forward[i][1] * v[1]
            for x in (0, 1):
                for y in (0, 1):
                    moves[x][y] += forward[i][x] * m[x][y] * e[y] * b[y] / z
            top = v[0] + v[1]
            backward[i] = (v[0] / top, v[1] / top)
        main = []
        for f, b in zip(forward, backward):
            p = (f[0] * b[0], f[1] * b[1])
            main.append(p[1] / (p[0] + p[1]))
        return main, moves

    def fit(self, pages: list[tuple[list[list[str]], list[int]]], seed: int = 0) -> Field:
        order, sums = random.Random(seed), {}
        pages = [p for p in pages if p[0]]
        for _ in range(EPOCHS):
            order.shuffle(pages)
            for found, labels in pages:
                main, moves = self.expectations(self.scores(found))
                slope: dict = {}
                for fs, y, p in zip(found, labels, main):
                    for f in fs:
                        slope[f] = slope.get(f, 0.0) + y - p
                for a, b in zip(labels, labels[1:]):
                    moves[a][b] -= 1
                for x in (0, 1):
                    for y in (0, 1):
                        slope[x, y] = -moves[x][y]
                for f, g in slope.items():
                    old = self.moves[f[0]][f[1]] if isinstance(f, tuple) else self.weights.get(f, 0.0)
                    g -= 0.002 * old
                    sums[f] = sums.get(f, 0.0) + g * g
                    new = old + RATE * g / math.sqrt(sums[f] + 1e-8)
                    if isinstance(f, tuple):
                        self.moves[f[0]][f[1]] = new
                    else:
                        self.weights[f] = new
        return self

    def extract(self, page: str | None) -> str:
        blocks = blocks_of(page)
        labels = self.decode(self.scores(features(blocks)))
        return "\n\n".join(b.text for b, y in zip(blocks, labels) if y)


# --- labelled pages ---------------------------------------------------------------------------


def semantic_labels(blocks: list[Block]) -> list[int] | None:
    """1 inside article or main tags and outside what such pages mark as something else; None without such tags."""
    if not any(MAIN_TAGS & set(b.tags) for b in blocks):
        return None
    out = []
    for b in blocks:
        names = {w for ws in b.names for w in ws}
        out.append(int(bool(MAIN_TAGS & set(b.tags)) and not OTHER_TAGS & set(b.tags) and not OTHER_NAMES & names))
    return out


# What each part of a made-up layout is wrapped in: opening tags, closed in reverse.
WRAPS = {
    "main": ["<article>", "<main>", "<main><article>", '<div class="content">', '<div id="content"><div class="post">', '<div class="entry-content">', '<div class="article-body">', '<section class="story">', '<div class="main-text">', '<div class="post-body">', "<div>", '<div id="main">', '<div class="container"><div class="text">'],
    "menu": ["<nav>", '<div class="nav">', '<div id="menu">', '<ul class="menu">', '<div class="navigation">', '<div class="topnav">', '<div class="breadcrumbs">', "<header><nav>", "<menu>"],
    "header": ["<header>", '<div class="header">', '<div id="masthead">', '<div class="site-title">', '<div class="topbar">'],
    "ad": ['<div class="ad">', '<div class="ads">', '<div class="advert">', '<div class="sponsored">', '<div class="promo">', '<div id="banner-ad">', '<section class="advertisement">'],
    "side": ["<aside>", '<div class="sidebar">', '<div id="sidebar">', '<div class="widget">', '<div class="related">', '<section class="recommended">', '<aside class="side">'],
    "notice": ['<div class="cookie">', '<div class="cookie-notice">', '<div id="notice">', '<div class="consent">', '<div class="alert">', '<div role="dialog">', '<div class="gdpr-banner">', '<div class="popup">', '<div class="notice">'],
    "form": ["<form>", '<form class="search">', '<div class="newsletter"><form>', '<div class="subscribe">', '<form id="login">', "<form><fieldset>"],
    "comments": ['<section id="comments">', '<div class="comments"><div class="comment">', '<ol class="commentlist"><li>', '<div class="discussion">', '<div id="responses">', '<section class="comments"><article class="comment">', '<div class="replies">', '<div id="disqus-thread">'],
    "footer": ["<footer>", '<div class="footer">', '<div id="footer">', '<div class="copyright">', "<footer><div>"],
    "share": ['<div class="share">', '<ul class="social">', '<div class="tags">', '<div class="byline">'],
}


def _wrapped(kind: str, inner: str, pick: random.Random) -> str:
    wrap = pick.choice(WRAPS[kind])
    tags = re.findall(r"<(\w+)", wrap)
    return wrap + inner + "".join(f"</{t}>" for t in reversed(tags))


def made_up(title: str, paragraphs: list[str], spare: list[str], pick: random.Random) -> tuple[str, list[tuple[str, int]]]:
    """A page with these paragraphs and other text around them: html, and (block text, label) in page order."""
    truth: list[tuple[str, int]] = []

    def line(label: int, text: str, tag: str = "p") -> str:
        truth.append((" ".join(text.split()), label))
        return f"<{tag}>{html.escape(text)}</{tag}>"

    def some(least: int = 1, most: int = 3) -> list[str]:
        return [pick.choice(spare) for _ in range(pick.randint(least, most))]

    def words() -> list[str]:
        return [" ".join(pick.choice(spare).split()[:2]) or "x" for _ in range(pick.randint(2, 6))]

    def part(kind: str) -> str:
        if kind in ("menu", "share"):
            return _wrapped(kind, "<ul>" + "".join(f'<li><a href="/x">{line(0, w, "span")}</a></li>' for w in words()) + "</ul>", pick)
        if kind == "form":
            return _wrapped(kind, "".join(line(0, w, "div") for w in words()[:3]) + '<input name="q">', pick)
        if kind == "footer":
            return _wrapped(kind, line(0, "© " + pick.choice(spare), pick.choice(("p", "div"))), pick)
        return _wrapped(kind, "".join(line(0, t, pick.choice(("p", "p", "div"))) for t in some()), pick)

    before = [k for k in ("header", "menu", "notice", "ad", "side", "form") if pick.random() < 0.5]
    after = [k for k in ("share", "comments", "side", "ad", "form", "notice", "menu", "footer") if pick.random() < 0.5]
    page = "<body>" + "".join(map(part, before))
    body = line(1, title, pick.choice(("h1", "h1", "h2")))
    for text in paragraphs:
        body += line(1, text, pick.choice(("p",) * 8 + ("h2", "li", "blockquote", "div", "td")))
        if pick.random() < 0.06:
            body += part(pick.choice(("ad", "side", "form", "share", "notice")))
    page += _wrapped("main", body, pick) + "".join(map(part, after)) + "</body>"
    return page, truth


def labelled_pages(pages: list[str], layouts: int = LAYOUTS) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels of the semantic pages given and of their new layouts."""
    out, told = [], []
    for page in pages:
        blocks = blocks_of(page)
        labels = semantic_labels(blocks)
        if labels is not None and any(labels):
            out.append((features(blocks), labels))
            told.append((blocks, labels))
    spare = [b.text[:300] for blocks, labels in told for b, y in zip(blocks, labels) if not y and len(b.text) > 20]
    spare += [b.text[:200] for blocks, labels in told for b, y in zip(blocks, labels) if y][::7]
    spare = spare or ["x y z"]
    for k, (blocks, labels) in enumerate(told):
        main = [b.text for b, y in zip(blocks, labels) if y]
        for layout in range(layouts):
            pick = random.Random(f"{k}/{layout}")
            page, truth = made_up(main[0], main[1:40], spare, pick)
            found = blocks_of(page)
            if [b.text for b in found] == [t for t, _ in truth]:
                out.append((features(found), [y for _, y in truth]))
    return out


def train(pages: DataFrame, sample: int = SAMPLE) -> Field:
    """Train on ``sample`` pages picked by a hash of their text; without semantic pages nothing is main text."""
    total = pages.where(F.length("html") > 0).count()
    if not total:
        return Field()
    place = F.pmod(F.xxhash64("html"), F.lit(1 << 20))
    picked = pages.where((F.length("html") > 0) & (place < max(1, int((1 << 20) * min(1.0, 2 * sample / total)))))
    rows = picked.select(F.substring("html", 1, SAMPLE_CHARS).alias("html")).orderBy(F.xxhash64("html"), "html").limit(sample).collect()
    return Field().fit(labelled_pages([r["html"] for r in rows]))


def extract(pages: DataFrame, field: Field, *keep: str) -> DataFrame:
    """Columns ``keep`` of every page with text and n_chars; a NULL or empty page has the text ""."""
    spark = prepare(pages.sparkSession)
    shared = spark.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.extract(page) for page in batch.column("_html").to_pylist()]
            batch = batch.select(list(keep)).append_column("text", pa.array(found, pa.string()))
            yield batch.append_column("n_chars", pa.array(map(len, found), pa.int64()))

    return pages.select(*keep, F.col("html").alias("_html")).mapInArrow(run, pages.select(*keep).schema.add("text", "string").add("n_chars", "long"))


def extract_main_text(pages: DataFrame, *keep: str) -> DataFrame:
    """Train on a sample of ``pages`` and extract all of them."""
    return extract(pages, train(pages), *keep)

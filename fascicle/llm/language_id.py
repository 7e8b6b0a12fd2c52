"""Language identification by cross-parsing entropy against suffix automata.

Each language's model is the suffix automaton of a bounded sample of its labelled text. A text is
parsed greedily into the longest phrases that occur in the sample; a phrase costs the bits of a
pointer into the sample, and the language with the fewest bits wins. The score is that language's
share of 2^-bits, so 1 means no other language comes near.

Texts are lower-cased, a run of anything but letters and marks is one symbol, and a letter that a
language's sample does not have is a phrase of its own there. A text is parsed in blocks of ``BLOCK``
symbols, all of them, and numpy steps the blocks of many documents at once. The alphabet of a language
is all letters of its sample: transitions by its ``DENSE`` commonest symbols are a table, those by rarer
ones, most of a script with thousands of characters, a sorted list.

Every labelled language is learned. Only the labelled rows read are bounded, by parameters:
``SAMPLE_DOCS`` documents of each language, one for each bucket of a hash of their ids, ``SAMPLE_CHARS``
characters of each language, fewer for each when there are many languages (``TOTAL_CHARS``).
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import small_side
from .common import id_crc, prepare

UNKNOWN = "und"
SAMPLE_DOCS = 64
SAMPLE_CHARS = 32_000
TOTAL_CHARS = 320_000
BLOCK = 256
DENSE = 126
# Symbols that are stepped through the automata at once.
GROUP = 2 << 20
LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    """Alphabet and sample texts by language, in alphabetical order of the languages."""

    languages: tuple[str, ...]
    samples: tuple[tuple[str, ...], ...]


def held_out(column: str = "doc_id"):
    """Rows that take no part in learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(id_crc(column), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame) -> Model:
    """Sample the labelled rows that are not held out; rows without id, text or lang teach nothing."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out())
    order = F.xxhash64(F.col("doc_id"))
    picked = known.groupBy("lang", F.pmod(order, F.lit(SAMPLE_DOCS)).alias("b")).agg(
        F.min_by("doc_id", F.struct(order, "doc_id")).alias("doc_id"), F.count("*").alias("n"))
    sizes: Counter[str] = Counter()
    for row in picked.groupBy("lang").agg(F.sum("n").alias("n")).collect():
        sizes[row["lang"]] = row["n"]
    if not sizes:
        return Model((), ())
    chars = min(SAMPLE_CHARS, TOTAL_CHARS // len(sizes))
    each = -(-2 * chars // SAMPLE_DOCS)
    texts: dict[str, list[str]] = {lang: [] for lang in sizes}
    chosen = small_side(picked.select("doc_id").distinct())  # SAMPLE_DOCS for each language at most
    sample = known.join(chosen, "doc_id", "left_semi").select("doc_id", "lang", F.substring("text", 1, each).alias("text"))
    for row in sorted(sample.collect(), key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        if row["lang"] in texts and sum(map(len, texts[row["lang"]])) < chars:
            texts[row["lang"]].append(row["text"])
    order = tuple(sorted(lang for lang in texts if any(LETTER.search(t) for t in texts[lang])))
    return Model(order, tuple(tuple(texts[lang]) for lang in order))


def fold(text: str) -> np.ndarray:
    """Code points of the lower-cased text."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def symbol_table(model: Model) -> tuple[np.ndarray, int]:
    """Symbol of every code point and their number: 0 unless a letter or mark, the letters of all samples, last any other letter."""
    letters = np.fromiter((unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)), bool, 0x110000)
    seen = np.zeros(0x110000, bool)
    for sample in model.samples:
        for text in sample:
            seen[fold(text)] = True
    named = np.flatnonzero(seen & letters)
    table = np.where(letters, len(named) + 1, 0).astype(np.int32)
    table[named] = np.arange(1, len(named) + 1)
    return table, len(named) + 2


def symbols_of(text: str, table: np.ndarray) -> np.ndarray:
    symbols = table[fold(text)]
    return symbols[np.append(True, (symbols[1:] != 0) | (symbols[:-1] != 0))[: len(symbols)]]


def suffix_automaton(sequences: list[list[int]], other: int) -> list[dict[int, int]]:
    """Transitions {symbol: state} of the automaton of all substrings without ``other``; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def clone(p: int, c: int) -> int:
        """The state for the longest string of ``p`` followed by ``c``, split off if needed."""
        q = step[p][c]
        if length[p] + 1 == length[q]:
            return q
        new = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = new
        while p >= 0 and step[p].get(c) == q:
            step[p][c] = new
            p = link[p]
        return new

    for sequence in sequences:
        last = 0
        for c in sequence:
            if c == other:
                last = 0
                continue
            if c in step[last]:
                last = clone(last, c)
                continue
            new = len(step)
            step.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p >= 0:
                link[new] = clone(p, c)
            last = new
    return step


class Automaton:
    """Transitions as arrays: a table for the commonest symbols, a sorted list for the rest.

    States are multiplied by the table's width; 0 as a target means that there is no transition. The
    table's last column, always 0, stands for symbols the language does not have.
    """

    def __init__(self, sequences: list[list[int]], symbols: int):
        step = suffix_automaton(sequences, symbols - 1)
        counts = Counter(c for s in sequences for c in s if c != symbols - 1)
        common = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:DENSE]]
        self.width, self.symbols = len(common) + 1, symbols
        # column of a symbol, -1 for one in the list; the symbol after the last is padding
        self.column = np.full(symbols + 1, len(common), np.int32)
        self.column[list(counts)] = -1
        self.column[common] = np.arange(len(common))
        self.table = np.zeros(len(step) * self.width, np.int32)
        listed = []
        for state, edges in enumerate(step):
            for c, target in edges.items():
                if self.column[c] >= 0:
                    self.table[state * self.width + self.column[c]] = target * self.width
                else:
                    listed.append((state * symbols + c, target * self.width))
        listed.sort()
        self.keys = np.array([k for k, _ in listed] + [np.iinfo(np.int64).max], np.int64)
        self.targets = np.array([t for _, t in listed] + [0], np.int32)
        self.start = np.zeros(symbols + 1, np.int32)
        for c, target in step[0].items():
            self.start[c] = target * self.width

    def after(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        column = self.column.take(c)
        if len(self.keys) == 1:
            return self.table.take(state + column)
        listed = np.flatnonzero(column < 0)
        out = self.table.take(state + np.maximum(column, 0))
        if len(listed):
            wanted = state[listed].astype(np.int64) // self.width * self.symbols + c[listed]
            at = np.searchsorted(self.keys, wanted)
            out[listed] = np.where(self.keys[at] == wanted, self.targets[at], 0)
        return out


class Parser:
    def __init__(self, model: Model):
        self.model = model
        self.symbols, count = symbol_table(model)
        self.other, self.pad = count - 1, count
        self.tables = [Automaton([symbols_of(t, self.symbols).tolist() for t in sample], count) for sample in model.samples]
        # bits of a phrase: a pointer into the sample
        self.bits = [math.log2(2 + sum(map(len, sample))) for sample in model.samples]

    def phrases(self, symbols: list[np.ndarray]) -> np.ndarray:
        """Phrases by text, given as symbols, and language."""
        counts = [-(-len(s) // BLOCK) for s in symbols]
        blocks = np.full((sum(counts), BLOCK), self.pad, np.int32)
        flat, at = blocks.reshape(-1), 0
        for s, n in zip(symbols, counts):
            flat[at : at + len(s)] = s
            at += n * BLOCK
        pads = (blocks == self.pad).sum(axis=1)
        by_step = np.ascontiguousarray(blocks.T)
        owner = np.repeat(np.arange(len(symbols)), counts)
        out = np.zeros((len(symbols), len(self.tables)))
        for k, table in enumerate(self.tables):
            state = np.zeros(blocks.shape[0], np.int32)
            found = np.zeros(blocks.shape[0], np.int32)
            for c in by_step:
                after = table.after(state, c)
                new = after == 0
                found += new | (state == 0)
                state = np.where(new, table.start.take(c), after)
            out[:, k] = np.bincount(owner, found - pads, len(symbols))
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        real = [i for i, t in enumerate(texts) if t and self.tables and LETTER.search(t)]
        start = 0
        while start < len(real):
            end, size = start, 0
            while end < len(real) and (size == 0 or size + len(texts[real[end]]) <= GROUP):
                size += len(texts[real[end]])
                end += 1
            group = real[start:end]
            symbols = [symbols_of(texts[i], self.symbols) for i in group]
            cost = self.phrases(symbols) if size <= GROUP else self.long(symbols[0])
            cost = cost * self.bits
            best = cost.argmin(axis=1)
            share = 1 / np.exp2(-(cost - cost.min(axis=1, keepdims=True))).sum(axis=1)
            for i, b, s in zip(group, best, share):
                out[i] = (self.model.languages[b], float(s))
            start = end
        return out

    def long(self, symbols: np.ndarray) -> np.ndarray:
        """Phrases of one text that is longer than a group, part by part at block borders."""
        return sum(self.phrases([symbols[i : i + GROUP]]) for i in range(0, len(symbols), GROUP))


PARSERS: dict[Model, Parser] = {}


def parser(model: Model) -> Parser:
    if model not in PARSERS:
        PARSERS.clear()
        PARSERS[model] = Parser(model)
    return PARSERS[model]


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Columns ``keep`` of every row with lang_pred and score.

    ``und`` and 0 for a text that is NULL or has no letter, and for every text if nothing was
    learned; equal costs go to the alphabetically first language. Only the text is looked at.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = parser(shared.value)
        for batch in batches:
            langs, scores = zip(*own.predict(batch.column("_text").to_pylist())) if batch.num_rows else ((), ())
            batch = batch.select(list(keep))
            yield batch.append_column("lang_pred", pa.array(langs, pa.string())).append_column("score", pa.array(scores, pa.float64()))

    rows = docs.select(*keep, F.col("text").alias("_text"))
    kept = docs.select(*keep).schema
    return rows.mapInArrow(run, kept.add("lang_pred", "string").add("score", "double"))


def with_letters(docs: DataFrame) -> DataFrame:
    """Rows whose text has a letter, which is all that can be asked where nothing was learned."""
    return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))


def identify(docs: DataFrame, *keep: str) -> DataFrame:
    """Learn from the labelled rows of ``docs`` and predict all of them."""
    return predict(docs, train(docs), *keep)

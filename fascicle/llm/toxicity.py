"""Toxicity by a weighted lexicon that an Aho-Corasick automaton matches in folded text.

Folding undoes disguise: compatibility forms and upper case, look-alike letters of other
alphabets, invisible characters, and digits or signs that stand for letters inside a word. The
lexicon holds whole words and word beginnings with weights, learned from labelled rows together
with exception phrases (two words) in which a match does not count. A document's evidence is the
sum of the weights matched, taken as such and per word; a logistic curve over both and the length
gives the score.

Learning is bounded: about ``SAMPLE`` labelled documents of each label picked by a hash of their
ids, ``MAX_PATTERNS`` patterns and ``MAX_EXCEPTIONS`` phrases. Patterns are learned on two thirds
of the sample and the curve on the rest.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_crc, prepare, texts

SAMPLE = 6000
MAX_PATTERNS = 2000
MAX_EXCEPTIONS = 2000
STEMS = range(4, 9)  # lengths of word beginnings that may become patterns
MIN_EVIDENCE = 25.0  # G statistic of a pattern's presence against the label
MIN_RATIO = 1.0  # log of its rate in toxic words to its rate in others

# Letters of other alphabets that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ı": "i",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
# Digits and signs that stand for letters inside a word.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
# Characters that are not seen.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"

FOLDED = str.maketrans({**LOOKALIKES, **dict.fromkeys(INVISIBLE)})
LETTERS_FOR = str.maketrans(SUBSTITUTES)
DISGUISED = re.compile(r"(?:(?<=[^\W\d_])|(?<!\S))[0134578@$!|]{1,3}(?=[^\W\d_])")
WORD = re.compile(r"[^\W\d_]+")
FEATURES = "feature string, toxic_words long, clean_words long, toxic_docs long, clean_docs long"


def folded_words(text: str | None) -> list[str]:
    """Words of a text after folding: runs of letters."""
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii():
        text = text.translate(FOLDED)
    return WORD.findall(DISGUISED.sub(lambda m: m[0].translate(LETTERS_FOR), text))


@dataclass
class Lexicon:
    """``patterns``: weight by pattern, a pattern is " word " or " beginning"; ``curve``: three factors and a constant."""

    patterns: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float, float] = (0.0, 0.0, 0.0, -5.0)
    automaton: object = None

    def __getstate__(self):
        return {**self.__dict__, "automaton": None}

    def compiled(self):
        if self.automaton is None:
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for p, w in self.patterns.items():
                self.automaton.add_word(p, (len(p), w))
            for p in self.exceptions:
                self.automaton.add_word(p, (len(p), None))
            if len(self.automaton):
                self.automaton.make_automaton()
        return self.automaton

    def matches(self, words: list[str]) -> list[tuple[int, int, float]]:
        """(start, end, weight) in the words joined by blanks; the longest pattern at a place, none inside an exception."""
        found = self.compiled()
        if not len(found):
            return []
        longest: dict[int, tuple[int, float]] = {}
        excepted = []
        for end, (size, weight) in found.iter(" " + " ".join(words) + " "):
            start = end - size + 1
            if weight is None:
                excepted.append((start, end + 1))
            elif start not in longest or end + 1 > longest[start][0]:
                longest[start] = (end + 1, weight)
        out, i = [], 0
        excepted.sort()
        for start in sorted(longest):
            end, weight = longest[start]
            while i < len(excepted) and excepted[i][1] <= start:
                i += 1
            if not any(a <= start and end <= b for a, b in excepted[i : i + 3]):
                out.append((start, end, weight))
        return out

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """Log of the matched weight, its log per thousand words, log of the length."""
        words = folded_words(text)
        total = sum(max(w, 0.0) for _, _, w in self.matches(words))
        return math.log1p(total), math.log1p(1000 * total / (len(words) + 20)), math.log1p(len(words))

    def score(self, text: str | None) -> float:
        z = sum(a * b for a, b in zip(self.curve, (*self.evidence(text), 1.0)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(column: str = "doc_id"):
    """Rows whose labels are not learned: crc32 of the id as text can be divided by 5."""
    return F.coalesce(F.pmod(id_crc(column), F.lit(5)) == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """text, toxic and part (0 to 2) of about ``size`` learnable documents of each label.

    An id labelled more than once is toxic if any of its labels says so.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    counts = {r["toxic"]: r["count"] for r in known.where(F.col("toxic").isin(0, 1)).groupBy("toxic").count().collect()}
    limits = [F.when(F.col("toxic") == t, place < int((1 << 20) * min(1.0, size / n))) for t, n in counts.items()]
    picked = known.where(F.coalesce(*limits)) if limits else known.limit(0)
    picked = picked.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)))
    # about 2 * size rows of two numbers, whatever the size of the tables
    return texts(docs, "doc_id").join(F.broadcast(picked), "doc_id").select("text", "toxic", "part")


def _counted(features_of):
    """Per batch: words and documents with each feature, by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, docs = (Counter(), Counter()), (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found = features_of(text)
                words[toxic].update(found)
                docs[toxic].update(found.keys())
            names = list(docs[0].keys() | docs[1].keys())
            counts = [pa.array([c[n] for n in names], pa.int64()) for c in (words[1], words[0], docs[1], docs[0])]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], names=["feature", "toxic_words", "clean_words", "toxic_docs", "clean_docs"])

    return run


def _stems(text: str) -> Counter:
    """Occurrences of whole words and of word beginnings, and of any word under the empty name."""
    out: Counter[str] = Counter()
    for word, n in Counter(folded_words(text)).items():
        out[""] += n
        out[f" {word} "] += n
        for size in STEMS:
            if size < len(word):
                out[" " + word[:size]] += n
    return out


def _summed(sample: DataFrame, features_of) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("toxic_words", "clean_words", "toxic_docs", "clean_docs")]
    return sample.mapInArrow(_counted(features_of), FEATURES).groupBy("feature").agg(*sums)


def evidence_against(a: float, b: float, n1: float, n0: float) -> float:
    """G statistic of a table with ``a`` of ``n1`` and ``b`` of ``n0``."""
    total, hit = n1 + n0, a + b
    cells = ((a, n1 * hit / total), (n1 - a, n1 * (total - hit) / total), (b, n0 * hit / total), (n0 - b, n0 * (total - hit) / total))
    return 2 * sum(o * math.log(o / e) for o, e in cells if o > 0 and e > 0)


def learn(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Lexicon:
    """Patterns, exceptions and curve; without rows of both labels an empty lexicon that scores low."""
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, size)
    counts = _summed(sample.where("part < 2"), _stems)
    sizes = {r["toxic"]: r["count"] for r in sample.where("part < 2").groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    total = counts.where("feature = ''").collect()
    if not total or not n1 or not n0:
        return Lexicon()
    w1, w0 = total[0]["toxic_words"], total[0]["clean_words"]
    rate = F.log((F.col("toxic_words") + 0.5) / (w1 + 1.0)) - F.log((F.col("clean_words") + 0.5) / (w0 + 1.0))
    lift = F.col("toxic_docs") * F.log((F.col("toxic_docs") + 0.5) / (n1 + 1.0) * (n0 + 1.0) / (F.col("clean_docs") + 0.5))
    ranked = counts.where((F.col("feature") != "") & (F.col("toxic_docs") >= 3) & (rate > MIN_RATIO)).orderBy(lift.desc(), F.length("feature").desc(), "feature")
    chosen: dict[str, float] = {}
    best = []
    for r in ranked.limit(4 * MAX_PATTERNS).collect():
        strength = evidence_against(r["toxic_docs"], r["clean_docs"], n1, n0)
        if strength >= MIN_EVIDENCE:
            best.append((-strength, -len(r["feature"]), r["feature"], math.log((r["toxic_words"] + 0.5) / (w1 + 1) / ((r["clean_words"] + 0.5) / (w0 + 1)))))
    for _, _, pattern, weight in sorted(best)[:MAX_PATTERNS]:
        stem = pattern.rstrip()
        if not any(p.rstrip().startswith(stem) or stem.startswith(p) for p in chosen):
            chosen[pattern] = weight
    lexicon = Lexicon(chosen)

    def phrases(text: str) -> Counter:
        words = folded_words(text)
        joined = " " + " ".join(words) + " "
        out: Counter[str] = Counter()
        for start, end, _ in lexicon.matches(words):
            first = joined.find(" ", start + 1)
            after = joined.find(" ", first + 1)
            before = joined.rfind(" ", 0, max(start, 0))
            if after > 0:
                out[joined[start : after + 1]] += 1
            if before >= 0:
                out[joined[before : first + 1]] += 1
        return out

    if chosen:
        mild = _summed(sample.where("part < 2"), phrases).where((F.col("clean_docs") >= 3) & (F.col("toxic_docs") * n0 < F.col("clean_docs") * n1))
        lexicon.exceptions = tuple(sorted(r["feature"] for r in mild.orderBy(F.desc("clean_docs"), "feature").limit(MAX_EXCEPTIONS).collect()))
        lexicon.automaton = None

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*map(lexicon.evidence, batch.column("text").to_pylist()))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.float64()) for c in columns), batch.column("toxic").cast(pa.int32())], names=["a", "b", "c", "toxic"])

    rows = sample.where("part = 2").select("text", "toxic").mapInArrow(measure, "a double, b double, c double, toxic int").collect()
    lexicon.curve = fit_curve([(r["a"], r["b"], r["c"]) for r in rows], [r["toxic"] for r in rows])
    return lexicon


def fit_curve(x: list[tuple[float, float, float]], y: list[int]) -> tuple[float, float, float, float]:
    """Logistic regression by Newton's steps with a light ridge; a low constant if only one label is there."""
    if len(set(y)) < 2:
        return Lexicon().curve
    a, t = np.column_stack([np.array(x, float), np.ones(len(y))]), np.array(y, float)
    w, ridge = np.zeros(4), np.diag([0.05, 0.05, 0.05, 0.01])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (t - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def score(docs: DataFrame, lexicon: Lexicon, *keep: str) -> DataFrame:
    """Columns ``keep`` with score (0 to 1) and predicted; an empty or NULL text gets the score of no match."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores = [own.score(t) for t in batch.column("_text").to_pylist()]
            batch = batch.select(list(keep)).append_column("score", pa.array(scores, pa.float64()))
            yield batch.append_column("predicted", pa.array([int(s >= 0.5) for s in scores], pa.int32()))

    rows = docs.select(*keep, F.col("text").alias("_text"))
    return rows.mapInArrow(run, docs.select(*keep).schema.add("score", "double").add("predicted", "integer"))

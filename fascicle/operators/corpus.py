"""Corpus statistics and extraction jobs."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.scalars import SPACE, col, replace_all, strip
from . import aggregates, joins, windows
from .generate import split_fold


def document_profile(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Fifteen statistics per document, all computed inside its row: no shuffle.

    Sentences and syllables are counted by pattern rules, so those two and the grade are
    approximations; the rest is exact.
    """
    t, w = col(text), F.col("_words")
    split = df.select(col(doc), t, X.words(t).alias("_words"))
    split = split.select("*", F.array_distinct("_words").alias("_distinct"))
    counted = split.select(
        col(doc),
        F.length(t).cast("bigint").alias("num_chars"), F.size(w).cast("bigint").alias("num_words"),
        X.count_runs(t, X.SENTENCE_MARKS).alias("num_sentences"), X.count_lines(t).alias("num_paragraphs"),
        X.count_chars(t, r"\p{Lu}").alias("num_uppercase"), X.count_chars(t, r"\p{Ll}").alias("num_lowercase"),
        X.count_chars(t, r"\p{Nd}").alias("num_digits"), X.count_chars(t, ".,;:!?").alias("num_punctuation"),
        # total word length is the text without whitespace
        F.length(F.regexp_replace(t, f"{SPACE}+", "")).alias("_letters"),
        X.count_runs(F.lower(t), X.VOWELS).alias("_syllables"),
        F.size("_distinct").cast("bigint").alias("num_unique_words"), X.first_by("_distinct", True).alias("longest_word"),
        X.first_by("_distinct", False).alias("shortest_word"), X.most_common(w).alias("most_common_word"),
    )
    n_words = F.col("num_words")

    def per_word(total: str) -> Column:
        return F.when(n_words > 0, F.col(total) / n_words).otherwise(F.lit(0.0))

    return counted.select(
        col(doc), "num_chars", "num_words", "num_sentences", "num_paragraphs",
        "num_uppercase", "num_lowercase", "num_digits", "num_punctuation",
        per_word("_letters").alias("avg_word_length"), per_word("num_unique_words").alias("lexical_diversity"),
        X.grade_level(n_words, F.col("num_sentences"), F.col("_syllables")).alias("readability"),
        "num_unique_words", "longest_word", "shortest_word", "most_common_word",
    )


def document_counts(df: DataFrame, doc: str, text: str) -> DataFrame:
    """The six-statistic form of the profile."""
    t, w = col(text), F.col("_words")
    n_words = F.size(w).cast("bigint")
    mean = F.when(n_words > 0, F.length(F.regexp_replace(t, f"{SPACE}+", "")) / n_words).otherwise(F.lit(0.0))
    return df.select(col(doc), t, X.words(t).alias("_words")).select(
        col(doc), F.length(t).cast("bigint").alias("num_chars"), n_words.alias("num_words"),
        X.count_runs(t, X.SENTENCE_MARKS).alias("num_sentences"), X.count_lines(t).alias("num_paragraphs"),
        mean.alias("avg_word_length"), F.size(F.array_distinct(w)).cast("bigint").alias("num_unique_words"),
    )


def string_frequencies(df: DataFrame, text: str) -> DataFrame:
    """Corpus frequency of normalised words that hold no digit."""
    exploded = df.select(F.explode(X.normalised_words(text)).alias("string")).filter(~X.has_digit("string"))
    return exploded.groupBy("string").agg(F.count("*").alias("frequency"))


def pareto_table(df: DataFrame, text: str) -> DataFrame:
    """Frequency, share, rank, running sum and Pareto percentage of every word."""
    return windows.pareto(string_frequencies(df, text))


def vocabulary_statistics(df: DataFrame, doc: str, text: str, vocabulary: DataFrame, entry: str = "entry") -> DataFrame:
    """Per document: count and dense rank of each vocabulary word it contains.

    The words of a document are counted before they meet the vocabulary. A document's distinct
    words fit its row, so the rank window is over bounded groups.
    """
    counts = aggregates.term_counts(df, doc, X.words(text), entry, one_row=True)
    return windows.dense_rank_in(joins.vocabulary_counts(counts, vocabulary, entry, entry), doc, "count")


# What joins the lines of an extracted dictionary, applied in this order.
LINE_JOINS = (("-\n", ""), (" \n", " "), ("([a-zA-Z0-9])\n([a-zA-Z0-9])", "$1 $2"), (" \x02 ", " "))
# Where a headword stands. Twice before a slash, or alone on a line.
REPEATED_HEADWORD = r"(?U)\b(\w+)\s+\1(?= /)"
LINE_HEADWORD = r"(?U)\n(\w+)\s\n"


def _dictionary(df: DataFrame, doc: str, text: Column, headword: str, lead: str = "") -> DataFrame:
    """(entry, definition) rows: each headword with the text up to the next one, after ``lead``.

    Text before the first headword belongs to none; a headword without text has the lead alone.
    """
    entries = F.regexp_extract_all(text, F.lit(headword), F.lit(1))
    between = F.split(text, headword, -1)
    following = F.transform(F.slice(between, 2, F.size(between)), lambda t: strip(F.concat(F.lit(lead), t)))
    rows = F.zip_with(entries, following, lambda e, d: F.struct(e.alias("entry"), d.alias("definition")))
    return df.select(col(doc), F.inline(rows))


def repeated_headword_entries(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Dictionary whose headwords stand twice before a slash; a definition starts at the slash."""
    lines = replace_all(text, LINE_JOINS, pattern=True)
    return _dictionary(df, doc, lines, REPEATED_HEADWORD)


def line_headword_entries(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Dictionary whose headwords stand alone on a line; definitions get the slash of the other form."""
    return _dictionary(df, doc, col(text), LINE_HEADWORD, "/")


def sentence_table(df: DataFrame, text: str, tag: Callable[[Column], tuple[Column, Column]] | None = None) -> DataFrame:
    """Distinct trimmed sentences of a corpus.

    Texts are unwrapped and cut after sentence punctuation and at line breaks. ``tag`` maps a
    sentence to two conditions, (has a verb, ends in punctuation); only sentences meeting both
    stay. Without a tagger the stand-in asks for closing punctuation alone.
    """
    plain = strip(X.unwrap_lines(text))
    cut = F.split(F.regexp_replace(plain, r"([.!?]+)\s+", "$1\n"), "\n")
    rows = df.select(F.explode(cut).alias("sentence"))
    rows = rows.select(strip("sentence").alias("sentence")).filter(F.col("sentence") != "")
    has_verb, closed = tag(F.col("sentence")) if tag else (F.lit(True), ends_sentence("sentence"))
    return rows.filter(has_verb & closed).distinct()


def ends_sentence(c: Column | str) -> Column:
    return F.substring(col(c), -1, 1).isin(".", "!", "?")


Tagger = Callable[[pd.Series], pd.Series]


def tag_words(df: DataFrame, doc: str, text: Column, tagger: Tagger, word: str = "word", tag: str = "tag",
              prefix: str = "") -> DataFrame:
    """One row per (word, tag) a tagger finds, of tags with a prefix.

    ``tagger`` maps a batch of texts to a batch of lists of (word, tag); it is the hook for a
    language model library and runs on Arrow batches. Tags are chosen before the pairs travel
    back to the JVM.
    """

    @F.pandas_udf(f"array<struct<{word}:string,{tag}:string>>")
    def run(texts: pd.Series) -> pd.Series:
        return tagger(texts).map(lambda pairs: [{word: w, tag: t} for w, t in pairs if t.startswith(prefix)])

    return df.select(col(doc), F.explode(run(text)).alias("_t")).select(col(doc), f"_t.{word}", f"_t.{tag}")


def suffix_tagger(texts: pd.Series) -> pd.Series:
    """Offline stand-in for a tagger: words ending in -ion or -ment are nouns, others are not.
    Makes the job testable; says nothing about tagging quality."""

    def one(text: str | None) -> list[tuple[str, str]]:
        return [(t, "NN" if t.lower().endswith(("ion", "ment")) else "XX") for t in re.findall(r"\w+", text or "")]

    return texts.map(one)


def stable_nouns(df: DataFrame, doc: str, text: str, tagger: Tagger = suffix_tagger) -> DataFrame:
    """Words tagged as nouns in the text as it is, in lower case and in upper case.

    The three forms are tagged in one pass. They meet again per document and word, where each
    holds only the few distinct spellings and tags of one word, so one shuffle does the work
    of de-duplicating and joining them.
    """
    t = col(text)
    forms = F.array(*[F.struct(F.lit(form).alias("form"), body.alias("body"))
                      for form, body in (("plain", t), ("lower", F.lower(t)), ("upper", F.upper(t)))])
    versions = df.select(col(doc), F.explode(forms).alias("_f")).select(
        F.struct(col(doc).alias("doc"), F.col("_f.form").alias("form")).alias("_id"), F.col("_f.body").alias("_body"))
    nouns = tag_words(versions, "_id", F.col("_body"), tagger, prefix="NN")

    def of(form: str, value: Column) -> Column:
        return F.collect_set(F.when(F.col("_id.form") == form, value))

    merged = nouns.groupBy(F.col("_id.doc").alias(doc), F.lower("word").alias("string")).agg(
        of("plain", F.struct("word", "tag")).alias("_w"), of("lower", F.col("tag")).alias("_l"), of("upper", F.col("tag")).alias("_u"),
    )
    return (
        merged.withColumn("_w", F.explode("_w")).withColumn("lower_tag", F.explode("_l")).withColumn("upper_tag", F.explode("_u"))
        .select(col(doc), "string", "_w.word", "_w.tag", "lower_tag", "upper_tag")
    )


def noun_frequencies(nouns: DataFrame, minimum: int = 2) -> DataFrame:
    """Frequency, share, rank and Pareto columns of nouns seen at least ``minimum`` times."""
    counted = nouns.groupBy("string").agg(F.count("*").alias("frequency")).filter(F.col("frequency") >= minimum)
    return windows.pareto(counted)


def below_share(table: DataFrame, limit: float = 80.0) -> DataFrame:
    """The terms that together make up less than ``limit`` percent."""
    return table.filter(F.col("pareto") < limit)


def entities(df: DataFrame, doc: str, text: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(document, entity, label) rows from ordered (label, pattern) rules."""

    def labelled(label: str, pattern: str) -> Column:
        hits = F.regexp_extract_all(col(text), F.lit(pattern), F.lit(0))
        return F.transform(hits, lambda e: F.struct(e.alias("entity"), F.lit(label).alias("label")))

    found = [labelled(label, pattern) for label, pattern in rules]
    return df.select(col(doc), F.explode(F.concat(*found)).alias("_e")).select(col(doc), "_e.entity", "_e.label")


def extracted(df: DataFrame, doc: str, text: str, extractor: Tagger) -> DataFrame:
    """(document, entity, label) rows from a pluggable extractor."""
    return tag_words(df, doc, col(text), extractor, "entity", "label")


def phrase_lists(df: DataFrame, doc: str, text: str, extractor: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    """The phrases of each document as an array column.

    ``extractor`` maps a batch of texts to lists of phrases. The stand-in takes runs of two or
    more capitalised words, inside the JVM.
    """
    if extractor is None:
        found = F.regexp_extract_all(col(text), F.lit(r"\p{Lu}\p{L}*(?: \p{Lu}\p{L}*)+"), F.lit(0))
    else:
        run = F.pandas_udf(extractor, "array<string>")
        found = run(col(text))
    return df.select(col(doc), found.alias("phrases"))


def parts_catalogue(df: DataFrame, column: str) -> DataFrame:
    """Comma lists to one sorted row per part; repeated parts stay."""
    return split_fold(df.select(col(column)), column).orderBy(column)

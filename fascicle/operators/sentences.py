"""Sentence boundaries learned from the texts themselves, without a list of abbreviations.

A period ends a sentence unless the word before it is an abbreviation. Abbreviations show in counts: the
word hardly ever occurs without its period, it is short, and it may hold periods of its own. The score is
the log-likelihood ratio of "the period belongs to the word" against "periods follow words by chance",
weighed by length, inner periods and the number of times the word was seen without one (Kiss and
Strunk's unsupervised statistic).

After an abbreviation a sentence may still end. The next word decides: written with a capital here,
in lower case elsewhere and never with a capital inside a sentence, it starts a new one.

All statistics are sums by word, combined in the reading task; equal tokens are counted before they are described. Only periods that follow an
abbreviation look the next word up; the tables are joined, and Spark sends them to the tasks if they are
measured as small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col
from ..session import materialise, small_side

THRESHOLD = 0.3
# Probability of a period after an abbreviation.
CERTAIN = 0.99
TOKEN = r"[^\x20\x09-\x0D]+"
# A token is a word without quotes and brackets around it; its end says whether it may close a sentence.
OPENING, CLOSING = "\"'([{«“‘", "\"')]}»”’"


def tokens(text: Column) -> Column:
    """Tokens between white space."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def end_of(raw: Column) -> Column:
    """The last mark of .!? of a token, or empty."""
    last = F.right(F.rtrim(raw, F.lit(CLOSING)), F.lit(1))
    return F.when(last.isin(".", "!", "?"), last).otherwise("")


def word_of(raw: Column) -> Column:
    """A token without quotes, brackets and its final period."""
    bare = F.rtrim(F.ltrim(raw, F.lit(OPENING)), F.lit(CLOSING))
    return F.when(F.right(bare, F.lit(1)) == ".", F.substr(bare, F.lit(1), F.length(bare) - 1)).otherwise(bare)


def _followed(df: DataFrame, text: str, *keep: Column) -> DataFrame:
    """(at, raw, after) of every token, places from 0, with the token behind it or NULL."""
    rows = df.select(*keep, tokens(col(text)).alias("_w"))
    placed = rows.select(*[c for c in rows.columns if c != "_w"], F.posexplode(F.arrays_zip(F.col("_w").alias("raw"), F.slice("_w", 2, F.size("_w")).alias("after"))).alias("at", "_t"))
    return placed.select(*[c for c in rows.columns if c != "_w"], "at", F.col("_t.raw").alias("raw"), F.col("_t.after").alias("after"))


def period_counts(df: DataFrame, text: str) -> DataFrame:
    """(type, n, with_period) of every lower-case word with a letter; tokens are counted as they are, and described once each."""
    counted = df.select(F.explode(tokens(col(text))).alias("raw")).groupBy("raw").agg(F.count("*").alias("n"))
    rows = counted.select(F.lower(word_of(F.col("raw"))).alias("type"), "n", F.when(end_of(F.col("raw")) == ".", F.col("n")).otherwise(0).alias("period"))
    return rows.filter(F.col("type").rlike(r"\p{L}")).groupBy("type").agg(F.sum("n").alias("n"), F.sum("period").alias("with_period"))


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """(type, n, with_period, score) of the words seen with a period."""
    counts = materialise(counts)  # read for the totals and for the scores
    total = counts.agg(F.sum("n").alias("n"), F.sum("with_period").alias("p")).first()
    chance = min(max((total["p"] or 0) / (total["n"] or 1), 1e-9), 1 - 1e-9)
    n, p = F.col("n"), F.col("with_period")

    def likelihood(q: float) -> Column:
        return p * F.ln(F.lit(q)) + (n - p) * F.ln(F.lit(1 - q))

    inner = F.length("type") - F.length(F.replace("type", F.lit("."), F.lit("")))
    letters = F.length("type") - inner
    ratio = -2 * (likelihood(chance) - likelihood(CERTAIN))
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(letters.cast("double"), -(n - p).cast("double"))
    return counts.filter("with_period > 0").select("type", "n", "with_period", F.round(score, 6).alias("score"))


def starter_counts(df: DataFrame, text: str) -> DataFrame:
    """(type, lower, inside): how often a word is in lower case, and with a capital after a token that closes nothing."""
    rows = _followed(df, text).filter("after IS NOT NULL")
    counted = rows.groupBy("after", (end_of(F.col("raw")) == "").alias("open")).agg(F.count("*").alias("n"))
    words = counted.select(word_of(F.col("after")).alias("word"), "open", "n").filter(F.col("word").rlike(r"^\p{L}"))
    small = F.col("word").rlike(r"^\p{Ll}")
    return words.groupBy(F.lower("word").alias("type")).agg(
        F.sum(F.when(small, F.col("n")).otherwise(0)).alias("lower"), F.sum(F.when(~small & F.col("open"), F.col("n")).otherwise(0)).alias("inside"))


def _marks(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, at, end, type, next) of the tokens that may close a sentence and have one behind them."""
    rows = _followed(df, text, col(id_column).alias("id")).withColumn("end", end_of(F.col("raw"))).filter("end != '' AND after IS NOT NULL")
    return rows.select("id", (F.col("at") + 1).alias("at"), "end", F.lower(word_of(F.col("raw"))).alias("type"), word_of(F.col("after")).alias("next"))


def boundaries(df: DataFrame, id_column: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """(id, at): a sentence of the text ends after its ``at``-th token; the end of the text is not listed."""
    known = small_side(abbreviation_scores(period_counts(df, text)).filter(F.col("score") >= threshold).select("type", F.lit(True).alias("short")))
    marks = _marks(df, id_column, text).join(known, "type", "left")
    short = F.coalesce("short", F.lit(False)) & (F.col("end") == ".")
    plain = marks.filter(~short).select("id", "at")
    capital = F.col("next").rlike(r"^\p{Lu}")
    starters = starter_counts(df, text).filter("lower > 0 AND inside = 0").select("type")
    after = marks.filter(short & capital).select("id", "at", F.lower("next").alias("type")).join(starters, "type", "left_semi")
    return plain.unionByName(after.select("id", "at"))


def split_sentences(df: DataFrame, id_column: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """(id, position, sentence) with the tokens of a sentence joined by blanks, positions from 1.

    Ids must be distinct. A text without a token has no sentence. The ends of one text are gathered,
    which are fewer than its tokens.
    """
    ends = boundaries(df, id_column, text, threshold).groupBy("id").agg(F.array_sort(F.collect_list("at")).alias("ends"))
    words = df.select(col(id_column).alias("id"), F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit(TOKEN), F.lit(0)).alias("w")).filter(F.size("w") > 0)
    joined = words.join(ends, "id", "left").withColumn("ends", F.concat(F.coalesce("ends", F.array().cast("array<int>")), F.array(F.size("w"))))
    starts = F.concat(F.array(F.lit(0)), F.slice("ends", 1, F.size("ends") - 1))
    cut = F.zip_with(starts, "ends", lambda a, b: F.array_join(F.slice("w", a + 1, b - a), " "))
    return joined.select("id", F.posexplode(cut).alias("position", "sentence")).select("id", (F.col("position") + 1).alias("position"), "sentence")


def sentence_counts(df: DataFrame, id_column: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """(id, sentences) of every text, 0 without a token."""
    ends = boundaries(df, id_column, text, threshold).groupBy("id").agg(F.count("*").alias("ends"))
    own = df.select(col(id_column).alias("id"), F.coalesce(col(text), F.lit("")).rlike(TOKEN).alias("some"))
    return own.join(ends, "id", "left").select("id", F.when(F.col("some"), F.coalesce("ends", F.lit(0)) + 1).otherwise(0).cast("bigint").alias("sentences"))

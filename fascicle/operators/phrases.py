"""Multi-word phrases ranked by C-value: frequency, length, and how far a phrase stands by itself.

A phrase that mostly occurs inside longer ones ("processing unit" in "central processing unit") is
worth less than its count says. The C-value takes the mean count of the longer phrases that hold it
from its own and weighs the rest by the logarithm of its length. Counts combine in the reading task,
and what longer phrases give to shorter ones is summed by phrase before the two meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col
from ..session import materialise

LONGEST = 4
LEAST = 3
# A phrase crosses no other mark than white space, hyphens and apostrophes inside words.
PIECE = r"[\p{L}\p{N}'\x20\t-]+"
WORD = r"[\p{L}\p{N}]+"


def _runs(words: Column, size: Column | int) -> Column:
    """All runs of ``size`` neighbouring words, joined by blanks."""
    last = F.size(words) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(words, i + 1, size), " "))).otherwise(F.array().cast("array<string>"))


def phrase_counts(df: DataFrame, text: str, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(phrase, words, n) of all runs of 2 to ``longest`` words that occur at least ``least`` times, in lower case."""
    pieces = df.select(F.explode(F.regexp_extract_all(F.lower(col(text)), F.lit(PIECE), F.lit(0))).alias("piece"))
    words = pieces.select(F.regexp_extract_all("piece", F.lit(WORD), F.lit(0)).alias("w")).filter(F.size("w") > 1)
    # every word with the words behind it, NULL beyond the end
    ahead = [F.col("w").alias("w1")] + [F.slice("w", n, F.size("w")).alias(f"w{n}") for n in range(2, longest + 1)]
    rows = words.select(F.explode(F.arrays_zip(*ahead)).alias("r")).select("r.*")
    runs = F.explode(F.array(*[F.concat(*[x for n in range(1, m + 1) for x in (F.lit(" "), F.col(f"w{n}"))][1:]) for m in range(2, longest + 1)]))
    counted = rows.select(runs.alias("phrase")).filter("phrase IS NOT NULL").groupBy("phrase").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return counted.select("phrase", F.size(F.split("phrase", " ")).cast("bigint").alias("words"), "n")


def c_values(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(phrase, words, n, longer, value): ``longer`` is the number of counted phrases that hold the phrase."""
    counts = materialise(counts)  # read for the phrases and for those that hold them
    words = F.split("phrase", " ")
    parts = F.array_distinct(F.concat(*[F.when(F.col("words") > n, _runs(words, n)).otherwise(F.array().cast("array<string>")) for n in range(2, longest)])) if longest > 2 else F.array().cast("array<string>")
    given = counts.select(F.explode(parts).alias("phrase"), "n").groupBy("phrase").agg(F.count("*").alias("longer"), F.sum("n").alias("within"))
    both = counts.join(given, "phrase", "left").fillna(0, ["longer", "within"])
    free = F.col("n") - F.when(F.col("longer") > 0, F.col("within") / F.col("longer")).otherwise(0.0)
    return both.select("phrase", "words", "n", "longer", F.round(F.log2("words") * free, 6).alias("value"))


def ranked_phrases(df: DataFrame, text: str, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """Phrases worth more than nothing with their C-value."""
    return c_values(phrase_counts(df, text, longest, least), longest).filter(F.col("value") > 0)

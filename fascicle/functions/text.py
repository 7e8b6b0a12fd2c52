"""Tokenising, cleaning and measuring text, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import SPACE, ColumnOrName, bound, col, replace_all

# The 32 ASCII punctuation marks.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Token patterns. Letter and digit classes are spelled out because \w is ASCII-only in
# Java while the corpus is multilingual.
WORD_OF_TWO = r"[\p{L}\p{N}_]{2,}"
ASCII_LETTERS = r"[a-zA-Z]+"


def words(text: ColumnOrName) -> Column:
    """Whitespace-separated pieces, no empty ones."""
    return F.array_remove(F.split(col(text), f"{SPACE}+"), "")


def strip_punctuation(text: ColumnOrName) -> Column:
    return F.translate(col(text), PUNCTUATION, "")


def normalised_words(text: ColumnOrName) -> Column:
    """Punctuation removed, lower case, split on whitespace."""
    return words(F.lower(strip_punctuation(text)))


def pattern_tokens(text: ColumnOrName, pattern: str = WORD_OF_TWO, lower: bool = True) -> Column:
    """Every match of a token pattern."""
    source = F.lower(col(text)) if lower else col(text)
    return F.regexp_extract_all(source, F.lit(pattern), F.lit(0))


def letter_tokens(text: ColumnOrName) -> Column:
    """Runs of ASCII letters that are whole words: a digit, underscore or accent next to the
    run disqualifies it, as a word boundary would."""
    whole_words = F.regexp_extract_all(F.lower(col(text)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return F.filter(whole_words, lambda w: w.rlike(rf"^{ASCII_LETTERS}$"))


def has_digit(c: ColumnOrName) -> Column:
    return col(c).rlike("[0-9]")


def unwrap_lines(text: ColumnOrName) -> Column:
    """Single line breaks become spaces, paragraph breaks stay, form feeds become line breaks."""
    marker = "\\pp"
    return replace_all(text, [("\n\n", marker), ("\n", " "), (marker, "\n\n"), ("\f", "\n")])


# The ordered substitutions that turn markdown into image alternative text, and
# the text of an image without a description.
ALT_TEXT_RULES = (
    (r"\n", " "),
    (r"#+\s+", ""),
    (r"[*_~`]", ""),
    (r"\[([^\]]+)\]\([^)]+\)", "$1"),
    (r"\|", " "),
    (r"[-:]+", ""),
    (r"```[\s\S]*?```", ""),
    (r"^\s*[\-\*\+]\s+", ""),
    (r"^\s*\d+\.\s+", ""),
    (r"\s+", " "),
    (r"^\s+|\s+$", ""),
)
NO_DESCRIPTION = "Image sans description"


def alt_text(description: ColumnOrName) -> Column:
    """Markdown description as one clean line; a fixed text when there is none."""
    c = col(description)
    missing = c.isNull() | (c == "")
    return F.when(missing, F.lit(NO_DESCRIPTION)).otherwise(replace_all(c, ALT_TEXT_RULES, pattern=True))


def _quoted(c: Column) -> Column:
    """Regular-expression literal of a value."""
    return F.concat(F.lit(r"\Q"), c, F.lit(r"\E"))


def _plain_replacement(c: Column) -> Column:
    """Replacement text with the characters that mean group references neutralised."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))


def describe_images(markdown: ColumnOrName, images: ColumnOrName) -> Column:
    """Put each image's description into the alternative text of its markdown reference.

    ``images`` is an array of structs with ``id`` and ``alt``. Covers ``![id](id)``,
    ``![](id)``, ``![any](id)`` and the older ``![](#image-id)`` form. The first three are
    one pattern, since any text may stand between the brackets.
    """

    def one(md: Column, image: Column) -> Column:
        key, alt = image["id"], _plain_replacement(image["alt"])
        current = F.concat(F.lit(r"!\[[^\]]*\]\("), _quoted(key), F.lit(r"\)"))
        older = F.concat(F.lit(r"!\[\]?\(#image-"), _quoted(key), F.lit(r"\)"))
        ref = _plain_replacement(key)
        md = F.regexp_replace(md, current, F.concat(F.lit("!["), alt, F.lit("]("), ref, F.lit(")")))
        return F.regexp_replace(
            md, older, F.concat(F.lit("!["), alt, F.lit("](#image-"), ref, F.lit(")"))
        )

    return F.aggregate(col(images), col(markdown), one)


def pages_text(pages: ColumnOrName, enriched: bool = False) -> Column:
    """Markdown of an array of page structs, joined by blank lines.

    ``enriched`` prefers each page's ``markdown_alt`` where it exists.
    """

    def body(page: Column) -> Column:
        if enriched:
            return F.coalesce(page["markdown_alt"], page["markdown"], F.lit(""))
        return F.coalesce(page["markdown"], F.lit(""))

    return F.array_join(F.transform(col(pages), body), "\n\n")


# Sentence and syllable counts follow the two rules below; they stand in for the
# readability library, so those counts are rule-based approximations.
SENTENCE_MARKS = ".!?"
VOWELS = "aeiouyàâäéèêëîïôöùûü"


def count_chars(text: ColumnOrName, members: str) -> Column:
    """Characters of a class, given as the inside of a bracket expression. What is not in the
    class is removed run by run, which builds no array of matches."""
    return F.length(F.regexp_replace(col(text), f"[^{members}]+", "")).cast("bigint")


def count_runs(text: ColumnOrName, members: str) -> Column:
    """Maximal runs of characters of a class."""
    return F.regexp_count(col(text), F.lit(f"[{members}]+")).cast("bigint")


def count_lines(text: ColumnOrName) -> Column:
    """Line breaks plus one."""
    return (F.length(col(text)) - F.length(F.replace(col(text), F.lit("\n"), F.lit(""))) + 1).cast("bigint")


def grade_level(n_words: Column, n_sentences: Column, n_syllables: Column) -> Column:
    """Flesch-Kincaid grade, 0 for empty text."""
    sentences = F.greatest(n_sentences, F.lit(1))
    grade = 0.39 * n_words / sentences + 11.8 * n_syllables / n_words - 15.59
    return F.when(n_words > 0, grade).otherwise(F.lit(0.0))


def first_by(tokens: ColumnOrName, longest: bool) -> Column:
    """The longest or shortest token; the first one in the array wins ties."""
    lengths = F.transform(col(tokens), lambda w: F.length(w))
    best = F.array_max(lengths) if longest else F.array_min(lengths)
    hit = bound(best, lambda n: F.get(F.filter(col(tokens), lambda w: F.length(w) == n), 0))
    return F.coalesce(hit, F.lit(""))


def token_runs(tokens: ColumnOrName) -> Column:
    """Array of (token, n): every distinct token of an array and how often it occurs.

    Sorting puts equal tokens next to each other; a run starts where the token before differs, and
    the distance between starts is the count. Linear after the sort, inside the row.
    """
    def runs(sorted_tokens: Column) -> Column:
        size = F.size(sorted_tokens)
        starts = F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (F.get(sorted_tokens, i) != F.get(sorted_tokens, i - 1)))

        def counted(starts: Column) -> Column:
            return F.transform(starts, lambda a, k: F.struct(F.get(sorted_tokens, a).alias("token"), (F.coalesce(F.get(starts, k + 1), size) - a).cast("bigint").alias("n")))

        return F.when(size > 0, bound(starts, counted)).otherwise(F.array().cast("array<struct<token:string,n:bigint>>"))

    return bound(F.sort_array(F.array_compact(col(tokens))), runs)


def most_common(tokens: ColumnOrName) -> Column:
    """The most frequent token of an array, first-seen wins ties; tokens hold no line break.

    Sorting puts equal tokens next to each other, one pattern takes the runs out, and the
    first token of the text that belongs to a longest run is the answer. Stays inside the row:
    no explode and no shuffle.
    """
    lines = F.concat(F.array_join(F.sort_array(col(tokens)), "\n"), F.lit("\n"))
    runs = F.regexp_extract_all(lines, F.lit(r"([^\n]+\n)\1*"), F.lit(0))

    def repeats(run: Column) -> Column:
        return F.length(run) / F.instr(run, "\n")

    def words_of_longest(found: Column) -> Column:
        longest = F.array_max(F.transform(found, lambda r: repeats(r)))
        tied = bound(longest, lambda n: F.filter(found, lambda r: repeats(r) == n))
        return F.transform(tied, lambda r: F.substring_index(r, "\n", 1))

    candidates = bound(runs, words_of_longest)
    return F.coalesce(F.get(F.array_intersect(col(tokens), candidates), 0), F.lit(""))

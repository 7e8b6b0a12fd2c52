"""Scalar expressions used by computed columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    """A column by name (any characters, dots and dashes too) or as given."""
    return c if isinstance(c, Column) else F.col("`" + c.replace("`", "``") + "`")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it. Matters
    inside higher-order functions, where a repeated expression runs again per element."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), 0)


# White space as Python's str.split and strip know it; \s is ASCII-only in Java and RE2.
SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def is_blank(c: ColumnOrName) -> Column:
    """NULL, empty or whitespace only: delimited files cannot tell these apart."""
    c = col(c)
    return c.isNull() | c.rlike(f"^{SPACE}*$")


def strip(c: ColumnOrName) -> Column:
    """Outer whitespace of any kind removed; ``trim`` takes spaces only."""
    return F.regexp_replace(col(c), f"^{SPACE}+|{SPACE}+$", "")


def blank_to(c: ColumnOrName, default: ColumnOrName) -> Column:
    """``c`` unless it is blank, else ``default``."""
    return F.when(is_blank(c), default if isinstance(default, Column) else F.lit(default)).otherwise(col(c))


def text_or_empty(c: ColumnOrName) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def join_text(*parts: ColumnOrName, sep: str = "") -> Column:
    """String addition in which a missing operand counts as empty."""
    return F.concat_ws(sep, *[text_or_empty(p) for p in parts])


def substring_between(c: ColumnOrName, start: int, end: int) -> Column:
    """Characters ``start`` (0-based) up to, not including, ``end``."""
    return F.substring(col(c), start + 1, end - start)


def short_sha1(c: ColumnOrName, length: int) -> Column:
    """The first ``length`` hex digits of the SHA-1 of the text form of ``c``."""
    return F.substring(F.sha1(col(c).cast("string")), 1, length)


def seeded_integer(seed: object, *keys: ColumnOrName, low: int, high: int) -> Column:
    """Repeatable pseudo-random integer in ``[low, high)`` for a seed and row keys.

    Uses 32 bits of SHA-1, so any engine with SHA-1 can reproduce the value; two runs,
    a retried task or another partitioning give the same numbers.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys])
    word = F.conv(F.substring(F.sha1(text), 1, 8), 16, 10).cast("bigint")
    return (F.lit(low) + word % F.lit(high - low)).cast("bigint")


def seeded_order(seed: object, *keys: ColumnOrName) -> Column:
    """Sort key that shuffles rows repeatably."""
    return F.sha1(F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys]))


def hours_before(as_of: ColumnOrName, hours: ColumnOrName) -> Column:
    """The instant ``hours`` before ``as_of``; pass ``as_of`` explicitly for repeatable runs."""
    return col(as_of) - F.make_interval(hours=col(hours).cast("int"))


def pick(values: Sequence[str], index: ColumnOrName) -> Column:
    """The list element at ``index`` modulo the list length."""
    choices = F.array(*[F.lit(v) for v in values])
    return F.element_at(choices, (F.pmod(col(index), F.lit(len(values))) + 1).cast("int"))


def clamp_or_seeded(c: ColumnOrName, low: int, high: int, seed: object, *keys: ColumnOrName) -> Column:
    """Text parsed as an integer when it lies in ``[low, high]``, else a seeded pick in that range."""
    parsed = F.trim(col(c)).try_cast("bigint")
    return F.when(parsed.between(low, high), parsed).otherwise(
        seeded_integer(seed, *keys, low=low, high=high + 1)
    )


def iso_day(c: ColumnOrName) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def parse_day(c: ColumnOrName) -> Column:
    """``yyyy-MM-dd`` text to a timestamp without zone; NULL for anything else."""
    return F.try_to_date(col(c), "yyyy-MM-dd").cast("timestamp_ntz")


def replace_all(c: ColumnOrName, mapping: Iterable[tuple[str, str | None]], pattern: bool = False) -> Column:
    """Ordered find/replace; a missing replacement deletes the match.

    ``pattern=True`` treats every ``from`` as a regular expression.
    """
    out = col(c)
    for find, put in mapping:
        put = put or ""
        out = F.regexp_replace(out, find, put) if pattern else F.replace(out, F.lit(find), F.lit(put))
    return out


def data_url_bytes(c: ColumnOrName) -> Column:
    """Decoded payload of a ``data:...;base64,xxxx`` URL: the part after the first comma."""
    return F.unbase64(F.split_part(col(c), F.lit(","), F.lit(2)))


def add(a: ColumnOrName, b: ColumnOrName) -> Column:
    """The shared two-argument helper function, kept as a plain expression."""
    return col(a) + col(b)

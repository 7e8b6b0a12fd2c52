"""Row filters. All are pure predicates, so they reach the scan where the source allows it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ColumnOrName, col, is_blank, strip


def keep_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose whole value is one of ``values``; blanks never match."""
    return df.filter(col(column).isin(list(values)))


def differs(column: ColumnOrName, value: object) -> Column:
    """Inequality under which a missing value differs from any given one."""
    return ~col(column).eqNullSafe(F.lit(value))


def exceeds(column: ColumnOrName, value: float) -> Column:
    return col(column) > F.lit(value)


def all_rules(df: DataFrame, rules: Iterable[Column]) -> DataFrame:
    """Rows that satisfy every rule."""
    return df.filter(reduce(lambda a, b: a & b, rules))


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~is_blank(column))


def drop_blank_after_trim(df: DataFrame, column: str) -> DataFrame:
    """Trim, then drop rows that are left empty or NULL."""
    return df.withColumn(column, strip(column)).filter(F.col(column) != "")


def value_counts(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Facet of a column: rows per value."""
    return df.groupBy(col(column)).agg(F.count("*").alias(count))


def in_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Numeric facet selection with either end open."""
    rules = [F.lit(True)]
    if low is not None:
        rules.append(col(column) >= low)
    if high is not None:
        rules.append(col(column) <= high)
    return all_rules(df, rules)

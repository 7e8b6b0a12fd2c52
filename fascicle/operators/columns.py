"""Choosing, renaming and computing columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import col, is_blank, join_text


def keep(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*map(col, names))


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Drop every column whose whole name matches; resolved from the schema, no job runs."""
    return df.select(*[col(c) for c in df.columns if not re.fullmatch(pattern, c)])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def compute(df: DataFrame, **columns: Column) -> DataFrame:
    """Create or overwrite columns."""
    return df.withColumns(columns)


def constant(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def nest(df: DataFrame, output: str, names: Sequence[str], as_text: bool = True) -> DataFrame:
    """Several columns as one JSON object; ``as_text=False`` keeps the struct."""
    value = F.struct(*map(col, names))
    return df.withColumn(output, F.to_json(value) if as_text else value)


def concat_columns(df: DataFrame, output: str, names: Sequence[str], sep: str = "") -> DataFrame:
    return df.withColumn(output, join_text(*names, sep=sep))


def select_sides(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                 keep_left: Mapping[str, str], keep_right: Mapping[str, str]) -> DataFrame:
    """Join, then pick and rename columns per side, so equal names on both sides are no problem."""
    l, r = left.alias("l"), right.alias("r")
    same = [F.col(f"l.`{k}`") == F.col(f"r.`{k}`") for k in on]
    picks = [F.col(f"l.`{k}`") for k in on]
    picks += [F.col(f"l.`{c}`").alias(a) for c, a in keep_left.items()]
    picks += [F.col(f"r.`{c}`").alias(a) for c, a in keep_right.items()]
    return l.join(r, same, how).select(*picks)


def fixed_layout(df: DataFrame, layout: Mapping[str, T.DataType | str]) -> DataFrame:
    """Columns in declared order and type; NULL for an absent one, others dropped."""
    have = set(df.columns)
    return df.select(*[
        (col(name) if name in have else F.lit(None)).cast(kind).alias(name) for name, kind in layout.items()
    ])


def fill_blank(df: DataFrame, column: str, source: str) -> DataFrame:
    """Take ``source`` where ``column`` is blank."""
    return df.withColumn(column, F.when(is_blank(column), col(source)).otherwise(col(column)))


def hashed_id(df: DataFrame, output: str, *keys: str, prefix: str = "doc") -> DataFrame:
    """Surrogate id from the row's key: no ordering pass, stable across runs."""
    text = F.concat_ws("|", *[col(k).cast("string") for k in keys])
    return df.withColumn(output, F.concat(F.lit(prefix), F.sha1(text)))


def numbered_id(df: DataFrame, output: str, *order: str, prefix: str = "doc") -> DataFrame:
    """Dense surrogate id ``<prefix>0, <prefix>1, ...`` in key order.

    Numbering runs over range partitions with per-partition offsets, never in one task.
    """
    from .windows import running_totals

    numbered = running_totals(df, order=list(map(col, order)), sums={"_n": F.lit(1)})
    return numbered.withColumn(output, F.concat(F.lit(prefix), (F.col("_n") - 1).cast("string"))).drop("_n")

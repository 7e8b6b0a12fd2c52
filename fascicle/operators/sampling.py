"""Sorting, limits and repeatable samples."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import col, seeded_integer, seeded_order
from ..session import materialise, small_side


def by_count(df: DataFrame, count: str, term: str) -> DataFrame:
    """Falling count, ties by term."""
    return df.orderBy(col(count).desc(), col(term))


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order; every task keeps its own first ``n`` before they meet.

    For the few rows a person or a page looks at. Rows equal in all order columns are picked at
    random, so order by enough columns to tell rows apart.
    """
    return df.orderBy(*map(col, order)).limit(n)


# Hash ranges whose rows are counted to find where a sample ends: the first digits of the hash.
HASH_DIGITS = 4


def exact_sample(df: DataFrame, n: int, seed: object, *keys: str) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones on every run: those with the smallest hash
    of seed and key.

    Rows are counted by the first digits of their hash. The ranges that fit the sample whole pass
    a filter; only the range in which the sample ends is ordered.
    """
    ranked = df.withColumn("_h", seeded_order(seed, *keys))
    area = F.substring("_h", 1, HASH_DIGITS)
    taken, border = 0, ""
    for row in ranked.groupBy(area.alias("area")).count().orderBy("area").collect():  # at most 16 ** HASH_DIGITS
        border = row["area"]
        if taken + row["count"] >= n:
            break
        taken += row["count"]
    else:
        return ranked.drop("_h")
    rest = ranked.filter(area == border).orderBy("_h", *map(col, keys)).limit(n - taken)
    return ranked.filter(area < border).unionByName(rest).drop("_h")


def balanced_sample(df: DataFrame, n: int, seed: object, group: str, *keys: str) -> DataFrame:
    """About ``n`` rows with an equal share per class; a smaller class gives all it has. Rows
    without a class are a class.

    As in ``exact_sample``, rows are counted by hash range, here for each class, and only the
    range in which a class's share ends is ranked.
    """
    ranked = df.withColumn("_h", seeded_order(seed, *keys)).withColumn("_class", F.struct(col(group)))
    area = F.conv(F.substring("_h", 1, HASH_DIGITS), 16, 10).cast("int")
    ranked = ranked.withColumn("_area", area)
    counts = materialise(ranked.groupBy("_class", "_area").agg(F.count("*").alias("_n")))
    share = math.ceil(n / max(counts.select("_class").distinct().count(), 1))
    before = W.partitionBy("_class").orderBy("_area").rowsBetween(W.unboundedPreceding, -1)
    laid = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # where the share of a class ends, and how many rows that range still gives
    ends = laid.filter((F.col("_before") < share) & (F.col("_before") + F.col("_n") >= share)).select("_class", F.col("_area").alias("_end"), (share - F.col("_before")).alias("_left"))
    placed = ranked.join(small_side(ends), "_class", "left")
    whole = placed.filter(F.col("_end").isNull() | (F.col("_area") < F.col("_end")))
    w = W.partitionBy("_class").orderBy("_h", *map(col, keys))
    last = placed.filter(F.col("_area") == F.col("_end")).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= F.col("_left")).drop("_r")
    return whole.unionByName(last).select(*[col(c) for c in df.columns])


def ratio_sample(df: DataFrame, ratio: float, seed: object, *keys: str) -> DataFrame:
    """Rows whose key hash falls below the ratio: no shuffle at all."""
    return df.filter(seeded_integer(seed, *keys, low=0, high=1_000_000) < int(ratio * 1_000_000))


def top_values(df: DataFrame, column: str, n: int = 10, count: str = "n") -> DataFrame:
    """The most frequent values with their counts, ties by value."""
    counted = df.groupBy(col(column)).agg(F.count("*").alias(count))
    return counted.orderBy(F.col(count).desc(), col(column)).limit(n)

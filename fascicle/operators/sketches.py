"""Quantiles and distinct counts from sketches that are stored per part and merged later.

A part (a day, a file, a type) is read once. Its row keeps a quantile sketch (KLL) and a distinct sketch
(HyperLogLog), both of bounded size however many rows the part has; any set of parts is answered by
merging their rows. An added or repeated day replaces its own folder and no other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import col

# Size of the quantile sketch, and base-2 logarithm of the distinct sketch's.
K = 400
LG = 12


def rank_error(k: int = K) -> float:
    """Error of a rank as a share of the rows that a quantile of a sketch, merged or not, keeps in 99 % of cases."""
    return 2.296 / k ** 0.9021


def distinct_error(lg: int = LG) -> float:
    """Three standard errors of a distinct count, as a share of it."""
    return 3 * 1.04 / 2 ** (lg / 2)


def part_sketches(df: DataFrame, parts: Sequence[str], value: str, k: int = K, lg: int = LG) -> DataFrame:
    """One row per part: rows, values that are not NULL, smallest, largest and the two sketches."""
    x = col(value).cast("double")
    return df.groupBy(*map(col, parts)).agg(
        F.count("*").alias("rows"), F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high"),
        F.kll_sketch_agg_double(x, F.lit(k)).alias("quantiles"), F.hll_sketch_agg(x.cast("string"), F.lit(lg)).alias("distinct"))


def save_sketches(df: DataFrame, path: str, parts: Sequence[str], value: str, k: int = K, lg: int = LG) -> None:
    """Sketch the parts of ``df`` into folders of the first part column; folders of other values stay."""
    part_sketches(df, parts, value, k, lg).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(parts[0]).parquet(path)


def merged_sketches(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The rows of several parts as one per key, or one in all; parts without a value add nothing."""
    return sketches.groupBy(*map(col, keys)).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"))


def summaries(merged: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """Numbers in place of the sketches: a column per probability, and ``distinct``; NULL without a value."""
    found = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(name) for name, p in probabilities.items()]
    others = [c for c in merged.columns if c not in ("quantiles", "distinct")]
    return merged.select(*map(col, others), *found, F.hll_sketch_estimate("distinct").alias("distinct"))


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

"""Checks and metrics of a table, each one aggregation over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col
from .aggregates import concat_groups, most_frequent
from .windows import exact_quantiles


def _outcome(ok: Column) -> Column:
    return F.when(ok, "OK").otherwise("ERROR")


def values_in_set(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Do all values belong to a set? Missing values do not count as violations."""
    bad = F.count(F.when(~col(column).isin(list(allowed)), 1))
    return df.agg(F.count("*").alias("n_rows"), bad.alias("violations")).select(
        F.lit(column).alias("column_name"), "n_rows", "violations", _outcome(F.col("violations") == 0).alias("outcome")
    )


def mode_in_set(df: DataFrame, column: str, allowed: Sequence[str], order: Column) -> DataFrame:
    """Is the most frequent value in a set? Ties go to the value seen first in ``order``."""
    mode = most_frequent(df.withColumn("_all", F.lit(1)), "_all", column, order, "mode_value")
    return mode.select(
        F.lit(column).alias("column_name"), "mode_value", F.col("mode_value_count").alias("mode_count"),
        _outcome(F.coalesce(F.col("mode_value").isin(list(allowed)), F.lit(False))).alias("outcome"),
    )


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("records")).select(F.lit(len(df.columns)).cast("bigint").alias("columns"), "records")


def storage_metrics(df: DataFrame, listing: DataFrame) -> DataFrame:
    """Columns, records, files and bytes of a stored table; ``listing`` is its folder listing."""
    files = listing.filter(~F.col("basename").startswith("_") & ~F.col("basename").startswith("."))
    sizes = files.agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    return record_count(df).select(
        "columns", "records",
        sizes.select("files").scalar().alias("files"), sizes.select("bytes").scalar().alias("bytes"),
    )


def consolidate_labels(df: DataFrame, record: str, label: str, comment: str, min_annotators: int = 1) -> DataFrame:
    """One row per record: agreed label or NULL, number of reviews, different comments joined.

    A record is verified when enough reviewers answered and no two labels differ; blank
    labels are allowed and do not count as an answer. Comments longer than one cell may hold
    continue on further rows of the record, numbered by ``part``.
    """
    given = F.when(F.trim(col(label)) != "", F.trim(col(label)))
    votes = df.groupBy(col(record)).agg(
        F.count(given).alias("n_labels"), F.min(given).alias("_low"), F.max(given).alias("_high"),
    )
    said = df.filter(F.trim(col(comment)) != "").select(col(record), col(comment).alias("_c")).distinct()
    comments = concat_groups(said, record, "_c", "_c", "\n", "comments")
    agreed = (F.col("n_labels") >= min_annotators) & (F.col("_low") == F.col("_high"))
    return votes.join(comments, record, "left").select(
        col(record), "n_labels", F.coalesce(agreed, F.lit(False)).alias("verified"),
        F.when(agreed, F.col("_low")).alias("label"), F.coalesce("part", F.lit(0)).cast("bigint").alias("part"), "comments",
    )


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Do two tables hold the same set of keys? One row; the sets are hashed apart, then counted."""
    left = a.select(*map(col, keys)).distinct().withColumn("_a", F.lit(1))
    right = b.select(*map(col, keys)).distinct().withColumn("_b", F.lit(1))
    both = left.join(right, list(keys), "full")
    return both.agg(
        F.count(F.when(F.col("_b").isNull(), 1)).alias("only_left"),
        F.count(F.when(F.col("_a").isNull(), 1)).alias("only_right"),
    ).withColumn("same", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def column_statistics(df: DataFrame, column: str, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Basic and percentile statistics of a numeric column."""
    v = col(column)
    basic = df.agg(F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"),
                   F.stddev(v).alias("stddev"))
    cuts = exact_quantiles(df, column, {f"p{int(p * 100)}": p for p in probabilities})
    both = basic.withColumn("_cuts", cuts.select(F.struct(*cuts.columns)).scalar())
    return both.select(*basic.columns, "_cuts.*")


def typed_share(df: DataFrame, column: str, kind: str) -> DataFrame:
    """How many values of a text column are valid for a type."""
    return df.agg(
        F.count(col(column)).alias("present"), F.count(col(column).try_cast(kind)).alias("valid")
    )

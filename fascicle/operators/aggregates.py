"""Grouping, counting and ordered concatenation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col
from ..functions.text import token_runs
from ..session import materialise
from .windows import exact_quantiles, running_totals

# Characters one concatenated cell may hold before the group is cut into numbered parts.
MAX_CELL = 64 * 1024 * 1024


def concat_groups(df: DataFrame, key: str, text: str, order: str, sep: str = "\n\n",
                  output: str = "chunk_concat", max_chars: int = MAX_CELL) -> DataFrame:
    """Text of each group joined in order, as rows (key, part, text); equal order values by text.

    The parts of a group, numbered from 0, are its whole text in order: a new part starts with the
    row at which the characters before it reach the next multiple of ``max_chars``. Rows are laid
    out by key and order with running lengths, so a group of any size spreads over many tasks and
    no task collects more than one part.
    """
    rows = df.select(col(key).alias(key), col(order).alias("_order"), col(text).alias("_text"))
    size = (F.coalesce(F.length("_text"), F.lit(0)) + len(sep)).cast("bigint")
    laid = running_totals(rows, order=[F.col("_order"), F.col("_text")], sums={"_end": size}, keys=[key])
    cut = laid.withColumn("part", F.floor((F.col("_end") - size) / F.lit(max_chars)).cast("bigint"))
    ordered = F.expr(f"listagg(_text, {_sql_text(sep)}) WITHIN GROUP (ORDER BY _order, _text)")
    return cut.groupBy(col(key), F.col("part")).agg(ordered.alias(output))


def _sql_text(s: str) -> str:
    escaped = s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t")
    return f"'{escaped}'"


def term_counts(df: DataFrame, doc: str, tokens: Column, term: str = "term", count: str = "count", one_row: bool = False) -> DataFrame:
    """Long document-term matrix: one row per document and distinct token.

    With ``one_row`` every document is a single row, so the counting happens inside it and nothing
    is shuffled; otherwise partial counts meet by document and token. The open vocabulary is never
    pivoted into columns.
    """
    if one_row:
        counted = df.select(col(doc).alias(doc), F.explode_outer(token_runs(tokens)).alias("_t")).filter(F.col("_t").isNotNull())
        return counted.select(col(doc), F.col("_t.token").alias(term), F.col("_t.n").alias(count))
    exploded = df.select(col(doc).alias(doc), F.explode(tokens).alias(term))
    return exploded.groupBy(col(doc), col(term)).agg(F.count("*").alias(count))


def corpus_counts(df: DataFrame, tokens: Column, term: str = "string", count: str = "frequency") -> DataFrame:
    """Corpus frequency of each token."""
    return df.select(F.explode(tokens).alias(term)).groupBy(col(term)).agg(F.count("*").alias(count))


def with_share(df: DataFrame, value: str, output: str = "relative_frequency") -> DataFrame:
    """Each row's share of the column total; the total is a scalar subquery, not a join."""
    total = df.agg(F.sum(col(value))).scalar()
    return df.withColumn(output, col(value) / total)


def widen(matrix: DataFrame, rows: str, columns: str, value: str, names: Sequence[object]) -> DataFrame:
    """Dense matrix for a declared list of columns; absent cells are 0."""
    wide = matrix.groupBy(col(rows)).pivot(columns, list(names)).agg(F.sum(col(value)))
    return wide.fillna(0)


def most_frequent(df: DataFrame, group: str, value: str, first_seen: Column, output: str = "mode") -> DataFrame:
    """The most frequent value of each group; the one seen first wins ties.

    Counted per (group, value) first, then one ``max_by`` per group over those counts: both
    steps combine before their shuffle, so a dominant group or value stays cheap.
    """
    counted = df.groupBy(col(group), col(value)).agg(F.count("*").alias("_n"), F.min(first_seen).alias("_first"))
    best = counted.groupBy(col(group), F.col("_n")).agg(F.min_by(col(value), F.col("_first")).alias("_v"))
    return best.groupBy(col(group)).agg(F.max_by("_v", "_n").alias(output), F.max("_n").alias(f"{output}_count"))


def binned_counts(df: DataFrame, x: str, color: str, bins: int = 10, max_colors: int = 50, others: str = "Others") -> DataFrame:
    """Rows per equal-width bin of ``x`` and category of ``color``, empty bins included.

    The range is a one-row aggregate read back as scalar subqueries. Categories beyond the
    ``max_colors`` most frequent are counted together under ``others``. The counts, one row
    per bin and category, are stored once, because three later steps read them.
    """
    low, high = df.agg(F.min(col(x))).scalar(), df.agg(F.max(col(x))).scalar()
    width = (high - low) / F.lit(bins)
    slot = F.when(width > 0, F.least(F.floor((col(x) - low) / width), F.lit(bins - 1))).otherwise(F.lit(0)).cast("bigint")
    counted = df.filter(col(x).isNotNull()).groupBy(slot.alias("bin"), col(color).cast("string").alias("category")).agg(F.count("*").alias("n"))
    return _fill_bins(_fold_colors(materialise(counted), max_colors, others), bins)


def category_bins(df: DataFrame, category: str, x: str, bins: int = 5, max_values: int = 50) -> DataFrame:
    """Rows per category and equal-width bin of ``x``."""
    return binned_counts(df, x, category, bins, max_values)


def _fold_colors(counted: DataFrame, limit: int, others: str) -> DataFrame:
    # counted has one row per (bin, category); the top list has at most `limit` rows.
    top = (
        counted.groupBy("category").agg(F.sum("n").alias("_t")).orderBy(F.desc("_t"), "category").limit(limit)
        .select(F.col("category").alias("_top"))
    )
    kept = counted.join(top, F.col("category").eqNullSafe(F.col("_top")), "left")
    name = F.when(F.col("_top").isNotNull() | F.col("category").isNull(), F.col("category")).otherwise(F.lit(others))
    return kept.groupBy("bin", name.alias("category")).agg(F.sum("n").alias("n"))


def _fill_bins(counted: DataFrame, bins: int) -> DataFrame:
    grid = counted.select("category").distinct().select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin"), "category"
    )
    side = counted.select(F.col("bin").alias("_b"), F.col("category").alias("_c"), "n")
    joined = grid.join(side, (F.col("bin") == F.col("_b")) & F.col("category").eqNullSafe(F.col("_c")), "left")
    return joined.select("bin", "category", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def grouped_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """The numeric aggregates a grouping step can declare."""
    v = col(value)
    basic = df.groupBy(col(key)).agg(
        F.count("*").alias("count"), F.count(v).alias(f"{value}_count"), F.countDistinct(v).alias(f"{value}_distinct"),
        F.min(v).alias(f"{value}_min"), F.max(v).alias(f"{value}_max"), F.avg(v).alias(f"{value}_avg"),
        F.sum(v).alias(f"{value}_sum"), F.sum(v * v).alias(f"{value}_sum2"), F.stddev(v).alias(f"{value}_stddev"),
    )
    return basic.join(exact_quantiles(df, value, {f"{value}_median": 0.5}, [key]), key, "left")


def first_last(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """First and last value of each group in a given order, and their not-null forms."""
    v, o = col(value), col(order)
    return df.groupBy(col(key)).agg(
        F.min_by(v, o).alias(f"{value}_first"), F.max_by(v, o).alias(f"{value}_last"),
        F.min_by(v, F.when(v.isNotNull(), o)).alias(f"{value}_first_not_null"),
        F.max_by(v, F.when(v.isNotNull(), o)).alias(f"{value}_last_not_null"),
    )


def concat_distinct(df: DataFrame, key: str, value: str, sep: str = ",", output: str | None = None) -> DataFrame:
    """Distinct values of each group joined in order; de-duplicated before they meet."""
    pairs = df.select(col(key), col(value).cast("string").alias("_text")).distinct()
    return concat_groups(pairs, key, "_text", "_text", sep, output or f"{value}_concat_distinct")

"""Ranks, running sums and pairings that keep working when one group holds most rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import bound, col
from ..session import materialise, small_side


def running_totals(df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column],
                   keys: Sequence[str] = ()) -> DataFrame:
    """Running sums over an ordered table, or per key group, without one task per group.

    The rows are range-partitioned by (keys, order), so a large group spreads over many
    partitions. That layout is checkpointed, because the partition number is used twice and
    must not change when a task is retried. Sums per partition give each one its starting
    offset; a window inside (partition, keys) does the rest. The offset table has one row per
    partition and group, and the only unpartitioned window runs over partition numbers.

    All columns of ``df`` are stored once on the way, so select what the result needs first.
    Rows equal in keys and order stay in one partition; order by enough columns to tell most
    rows apart.
    """
    names = list(sums)
    sort_names = [f"_o{i}" for i in range(len(order))]
    sorts = []
    staged = df.withColumns({f"_v{i}": sums[n] for i, n in enumerate(names)})
    for name, o in zip(sort_names, order):
        expr, descending = _plain(o)
        staged = staged.withColumn(name, expr)
        sorts.append(F.col(name).desc() if descending else F.col(name).asc())
    # a struct of the keys joins NULL keys like any other and serves join and window alike
    group = ["_pid", "_key"] if keys else ["_pid"]
    if keys:
        staged = staged.withColumn("_key", F.struct(*map(col, keys)))
    laid = materialise(
        staged.repartitionByRange(*map(col, keys), *sorts).withColumn("_pid", F.spark_partition_id())
    )
    totals = laid.groupBy(*group).agg(*[F.sum(f"_v{i}").alias(f"_t{i}") for i in range(len(names))])
    before = W.partitionBy(*group[1:]).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *group, *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_b{i}") for i in range(len(names))]
    )
    inside = W.partitionBy(*group).orderBy(*sorts).rowsBetween(W.unboundedPreceding, 0)
    out = laid.join(offsets, group).withColumns({
        n: F.col(f"_b{i}") + F.sum(f"_v{i}").over(inside) for i, n in enumerate(names)
    })
    return out.select(*map(col, df.columns), *map(col, names))


class Descending:
    """Marks a sort column as descending for ``running_totals``."""

    def __init__(self, column: Column | str):
        self.column = col(column)


def _plain(o: Column | Descending) -> tuple[Column, bool]:
    return (o.column, True) if isinstance(o, Descending) else (o, False)


def pareto(freqs: DataFrame, term: str = "string", freq: str = "frequency", running: str = "cumulative_sum") -> DataFrame:
    """Frequency table with relative share, shared-lowest rank, running sum and Pareto percentage.

    ``freqs`` has one row per term. Total and ranks come from the table of distinct
    frequencies, which has at most sqrt(2 x total) rows, since distinct counts add up to no
    more than the total. The running sum, ordered by falling frequency and then term, is
    range-partitioned.
    """
    # from here on everything reads the stored running sums; the counting runs once
    summed = running_totals(freqs, order=[Descending(freq), col(term)], sums={running: col(freq)})
    classes = summed.groupBy(col(freq)).agg(F.count("*").alias("_n"))
    above = W.orderBy(col(freq).desc()).rowsBetween(W.unboundedPreceding, -1)
    ranked = classes.select(
        col(freq),
        (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).cast("bigint").alias("rank"),
        F.sum(F.col("_n") * col(freq)).over(W.partitionBy()).alias("_total"),
    )
    return summed.join(small_side(ranked), freq).select(
        *[col(c) for c in freqs.columns],
        (col(freq) / F.col("_total")).alias("relative_frequency"), "rank",
        col(running).cast("bigint").alias(running),
        (col(running) / F.col("_total") * 100).alias("pareto"),
    )


def exact_quantiles(df: DataFrame, value: str, probabilities: Mapping[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated quantiles of a numeric column, whole or per key.

    Equal values are counted together, the counts are summed in value order over range
    partitions, and each quantile picks the values at its two neighbouring positions. No task
    holds all values of a group, as the built-in exact percentile would.
    """
    counted = df.filter(col(value).isNotNull()).groupBy(*map(col, keys), col(value).cast("double").alias("_x")).agg(F.count("*").alias("_n"))
    laid = running_totals(counted, order=[F.col("_x")], sums={"_end": F.col("_n")}, keys=keys)
    totals = laid.groupBy(*map(col, keys)).agg(F.sum("_n").alias("_total"))
    if keys:
        totals = totals.select(F.struct(*map(col, keys)).alias("_key"), "_total")
        placed = laid.withColumn("_key", F.struct(*map(col, keys))).join(totals, "_key")
    else:
        placed = laid.withColumn("_total", totals.scalar())

    def at(position: Column) -> Column:
        return F.max(F.when((position >= F.col("_end") - F.col("_n")) & (position < F.col("_end")), F.col("_x")))

    found = placed.groupBy(*map(col, keys)).agg(*[
        (at(F.floor(p * (F.col("_total") - 1))) + (at(F.ceil(p * (F.col("_total") - 1))) - at(F.floor(p * (F.col("_total") - 1))))
         * F.max(p * (F.col("_total") - 1) - F.floor(p * (F.col("_total") - 1)))).alias(name)
        for name, p in ((n, F.lit(float(q))) for n, q in probabilities.items())
    ])
    return found


def dense_rank_in(df: DataFrame, group: str, by: str, output: str = "rank") -> DataFrame:
    """Dense rank by falling value inside each group; for groups of bounded size, such as the
    distinct terms of one document."""
    return df.withColumn(output, F.dense_rank().over(W.partitionBy(col(group)).orderBy(col(by).desc())).cast("bigint"))


def dense_rank_of_counts(df: DataFrame, group: str, by: str, output: str = "rank") -> DataFrame:
    """Dense rank inside groups of any size.

    Only distinct (group, value) pairs are ranked, as running numbers over range partitions, so
    no task sorts a whole group; the rows take their rank by a join.
    """
    pair = F.struct(col(group), col(by))  # joins NULL groups like any other
    values = df.select(col(group), col(by)).distinct()
    ranked = running_totals(values, order=[Descending(by)], sums={output: F.lit(1).cast("bigint")}, keys=[group])
    return df.withColumn("_pair", pair).join(ranked.select(pair.alias("_pair"), output), "_pair").drop("_pair")


def running_sum_in(df: DataFrame, group: str, order: Sequence[Column], value: str, output: str) -> DataFrame:
    """Running sum inside each group; groups may be of any size."""
    return running_totals(df, order=order, sums={output: col(value)}, keys=[group])


def pair_with_next(items: Column, entry: str = "entry", definition: str = "definition") -> Column:
    """Array of (item, following item) pairs taken at every second position, starting at the
    second item: the marked headword and the text after it."""

    def pairs(xs: Column) -> Column:
        positions = F.sequence(F.lit(1), F.greatest(F.size(xs) - 1, F.lit(1)), F.lit(2))
        return F.when(F.size(xs) > 1, F.transform(positions, lambda i: F.struct(
            F.get(xs, i).alias(entry), F.coalesce(F.get(xs, i + 1), F.lit("")).alias(definition))))

    return bound(items, pairs)

"""Operators that produce rows: fold, split, multiply, expand steps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col, iso_day, seeded_integer, strip


def stack(*frames: DataFrame) -> DataFrame:
    """Vertical concatenation by name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def concat_arrays(df: DataFrame, output: str, names: Sequence[str]) -> DataFrame:
    """Several array columns as one; a missing array adds nothing."""
    parts = [F.coalesce(col(n), F.array().cast(df.schema[n].dataType)) for n in names]
    return df.withColumn(output, F.concat(*parts))


def fold_array(df: DataFrame, column: str, element: str = "string") -> DataFrame:
    """One row per element of an array, given as an array or as JSON text.

    The outer explode with its own filter stands for a plain one on purpose: for that the
    optimizer adds a size filter and computes an expensive array column a second time.
    """
    value = col(column)
    if df.schema[column].dataType.typeName() == "string":
        value = F.from_json(value, f"array<{element}>")
    others = [col(c) for c in df.columns if c != column]
    wrapped = F.transform(value, lambda x: F.struct(x.alias("v")))
    rows = df.select(*others, F.explode_outer(wrapped).alias("_e")).filter(F.col("_e").isNotNull())
    return rows.select(*[F.col("_e.v").alias(c) if c == column else col(c) for c in df.columns])


def split_fold(df: DataFrame, column: str, sep: str = ",") -> DataFrame:
    """Split text, trim the pieces, drop empty ones, one row each."""
    pieces = F.array_remove(F.transform(F.split(col(column), _literal(sep)), lambda p: strip(p)), "")
    others = [col(c) for c in df.columns if c != column]
    return df.select(*others, F.explode(pieces).alias(column)).select(*map(col, df.columns))


def _literal(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def multiply(df: DataFrame, factor: int, output: str = "copy") -> DataFrame:
    """Every row ``factor`` times, numbered from 0, without a join.

    The copies appear inside the task that read the row, so the input partitioning decides
    task size: repartition after it if a heavy step follows.
    """
    copies = F.sequence(F.lit(0).cast("bigint"), F.lit(factor - 1).cast("bigint"))
    return df.select("*", F.explode(copies).alias(output))


def explode_lines(df: DataFrame, column: str) -> DataFrame:
    """One row per line of a text column."""
    others = [col(c) for c in df.columns if c != column]
    return df.select(*others, F.explode(F.split(col(column), "\n")).alias(column)).select(*map(col, df.columns))


def expand_steps(tickets: DataFrame, ticket: str, opened: str, steps: Sequence[tuple[str, str, str]],
                 complexity: Column, actions: Column, seed: object,
                 action_steps: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Dated status history of each ticket from an ordered step list.

    ``steps`` holds (status, mandatory|optional, once|many). A seeded half of the optional
    steps is skipped; a ``many`` step repeats 1 to complexity times; a step named in
    ``action_steps`` adds one row per planned action, (low, high) days apart. After every
    plain row the date moves 6 to 36 hours on.

    The whole history is built as one array inside the ticket's row and its dates are a fold
    over that array, so no shuffle and no window is needed. Rows: ticket, seq, status, date.
    """
    key = col(ticket)
    action_steps = action_steps or {}

    def drawn(label: str, *parts: Column, low: int, high: int) -> Column:
        return seeded_integer(seed, key, F.lit(label), *parts, low=low, high=high)

    def plain_row(i: int, status: str):
        return lambda j: F.struct(
            F.lit(status).alias("status"), F.lit(0).cast("bigint").alias("before"),
            drawn(f"hours{i}", j, low=6, high=37).alias("after"),
        )

    def action_row(i: int, status: str, low: int, high: int):
        return lambda j: F.struct(
            F.concat(F.lit(f"{status} - Action "), j.cast("string")).alias("status"),
            (drawn(f"days{i}", j, low=low, high=high + 1) * 24).alias("before"), F.lit(0).cast("bigint").alias("after"),
        )

    plans = []
    for i, (status, kind, recurrence) in enumerate(steps):
        count = F.lit(1)
        if recurrence == "many":
            repeats = 1 + drawn(f"count{i}", low=0, high=1 << 32) % complexity
            count = F.when(complexity > 1, repeats).otherwise(F.lit(1)).cast("int")
        rows = F.transform(F.sequence(F.lit(1), count), plain_row(i, status))
        if status in action_steps:
            planned = F.sequence(F.lit(1), F.greatest(actions.cast("int"), F.lit(1)))
            rows = F.concat(rows, F.transform(planned, action_row(i, status, *action_steps[status])))
        if kind == "optional":
            rows = F.when(drawn(f"skip{i}", low=0, high=2) == 1, F.slice(rows, 1, 0)).otherwise(rows)
        plans.append(rows)
    history = tickets.select(key.alias(ticket), col(opened).alias("_opened"), F.concat(*plans).alias("_plan"))

    row = "struct<status:string,hours:bigint>"
    start = F.struct(F.lit(0).cast("bigint").alias("passed"), F.array().cast(f"array<{row}>").alias("rows"))

    def dated(acc: Column, step: Column) -> Column:
        opens = acc["passed"] + step["before"]
        dated_row = F.struct(step["status"].alias("status"), opens.alias("hours")).cast(row)
        return F.struct((opens + step["after"]).alias("passed"), F.concat(acc["rows"], F.array(dated_row)).alias("rows"))

    # one fold carries the hours passed and the rows so far
    rows = F.aggregate("_plan", start, dated, lambda acc: acc["rows"])
    exploded = history.select(ticket, "_opened", F.posexplode(rows).alias("seq", "_s"))
    when = F.col("_opened") + F.make_interval(hours=F.col("_s.hours").cast("int"))
    return exploded.select(
        col(ticket), F.col("seq").cast("bigint").alias("seq"), F.col("_s.status").alias("status"), iso_day(when).alias("date")
    )

"""Relational tables over JDBC.

No driver or database ships with this repository; the options are tested, the transfer is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows per insert batch.
BATCH_ROWS = 10_000


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None, **extra: str) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "driver": "org.postgresql.Driver", "batchsize": str(BATCH_ROWS),
               "preferTimestampNTZ": "true"}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return {**options, **extra}


def read_options(split_on: str | None = None, low: object = None, high: object = None, parts: int = 1) -> dict[str, str]:
    """Options that split a read over tasks by ranges of a column; one task without them."""
    if split_on is None:
        return {}
    return {"partitionColumn": split_on, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}


def read_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Batched inserts; an existing table is emptied, not dropped, on overwrite."""
    df.write.format("jdbc").options(truncate="true", **jdbc_options(url, table, **options)).mode(mode).save()

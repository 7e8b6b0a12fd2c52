"""What the operators here share: stored intermediate tables and row conventions.

Conventions of every operator: a NULL text counts as an empty one, only the columns named are
read (extra columns and clashing names do no harm), repeated rows are separate rows, and an empty
table gives an empty result with the same columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

# Rows and bytes that Spark hands to Python at once; with both a batch of long documents or large sets stays in memory.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20
# Bytes of a text that are cut into words at once.
PART = 4 << 20
GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package and keep Arrow batches small enough for tables of long texts."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: one computation, no lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """The named columns and ``text``, NULL texts as empty ones."""
    return docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of an id written as text; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, without decoding them."""
    for value in column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()):
        yield value.as_py() or b""


def parts(body: bytes) -> Iterator[bytes]:
    """The text in parts of about ``PART`` bytes that end at white space."""
    start = 0
    while len(body) - start > PART:
        gap = GAP.search(body, start + PART)
        if gap is None:
            break
        yield body[start : gap.start()]
        start = gap.start()
    yield body[start:]

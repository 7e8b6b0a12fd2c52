"""Delimited text tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import col

# Without these the writer trims every value.
_EXACT = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# The storage formats of managed and uploaded tables.
MANAGED = {"sep": "\t", "quote": '"', "escape": "\\", "header": "false", "encoding": "UTF-8", **_EXACT}
UPLOADED = {"sep": ";", "quote": '"', "escape": '"', "header": "true", "encoding": "UTF-8", "multiLine": "true", **_EXACT}

_NESTED = (T.ArrayType, T.MapType, T.StructType)
_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _is_nested(f: T.StructField) -> bool:
    return isinstance(f.dataType, _NESTED)


def write_managed(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Tab-separated, no header; arrays, maps and structs as JSON text; line breaks inside a
    value as they are.

    A gzip file cannot be split, so parallel reading comes from the number of files written.
    """
    flat = df.select(*[F.to_json(col(f.name)).alias(f.name) if _is_nested(f) else col(f.name) for f in df.schema])
    (flat.write.mode("overwrite").options(**MANAGED).option("compression", compression)
     .option("timestampNTZFormat", _INSTANT).option("timestampFormat", _INSTANT + "XXX")
     .option("quoteAll", "true").option("nullValue", None).csv(path))


def read_managed(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Read a managed table against its stored schema.

    Nested columns are parsed from JSON text. A value of the wrong type becomes NULL and the
    row stays; extra fields are ignored and missing ones are NULL. ``multi_line`` is needed
    when values hold line breaks; it makes a file the unit of parallelism, which a gzip file
    is anyway.
    """
    stored = T.StructType([T.StructField(f.name, T.StringType() if _is_nested(f) else f.dataType) for f in schema])
    raw = (spark.read.schema(stored).options(**MANAGED).option("mode", "PERMISSIVE")
           .option("multiLine", str(multi_line).lower()).option("timestampNTZFormat", _INSTANT)
           .option("timestampFormat", _INSTANT + "XXX").csv(path))
    return raw.select(*[
        F.from_json(col(f.name), f.dataType).alias(f.name) if _is_nested(f) else col(f.name) for f in schema
    ])


def read_uploaded(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """Semicolon table with a header row; names may hold spaces."""
    return spark.read.schema(schema).options(**{**UPLOADED, **options}).csv(path)


def write_uploaded(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**{k: v for k, v in UPLOADED.items() if k != "multiLine"}).csv(path)


def read_inline(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Inline table: one JSON document ``{"data": [[...], ...]}``, cells by position."""
    raw = spark.read.schema("data array<array<string>>").option("multiLine", "true").json(path)
    return _positional(raw.select(F.explode("data").alias("_row")), schema)


def inline_rows(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """The same document held in a text column."""
    parsed = F.from_json(col(column), "data array<array<string>>")
    return _positional(df.select(F.explode(parsed["data"]).alias("_row")), schema)


def _positional(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select(*[
        F.get("_row", i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema)
    ])


def inline_literal(spark: SparkSession, text: str, schema: T.StructType) -> DataFrame:
    """A small inline table kept in program text."""
    rows = [tuple(r) for r in json.loads(text)["data"]]
    names = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    return spark.createDataFrame(rows, names).select(*[col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


# Rows of an exported file: a compressed file is read by one task.
EXPORT_ROWS = 1_000_000


def export_csv(df: DataFrame, path: str, compression: str = "gzip", rows_per_file: int = EXPORT_ROWS) -> None:
    """Comma files with a header row, compressed; ``compression="none"`` for plain ones."""
    (df.write.mode("overwrite").option("header", "true").option("escape", '"').options(**_EXACT)
     .option("compression", compression).option("maxRecordsPerFile", rows_per_file).csv(path))


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines; non-ASCII characters as they are."""
    df.write.mode("overwrite").json(path)

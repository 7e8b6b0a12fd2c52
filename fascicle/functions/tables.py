"""Table functions for SQL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..operators.chunking import CHUNK_OVERLAP, CHUNK_SIZE, split_spans


class ChunkTable:
    """``chunk_table(TABLE(docs) [PARTITION BY (id)], 'text' [, size [, overlap]])``: the table's other columns, chunk_id, chunk.

    The result's columns follow the table given, so one function serves any table.
    """

    @staticmethod
    def analyze(table: AnalyzeArgument, text: AnalyzeArgument, size: AnalyzeArgument = None, overlap: AnalyzeArgument = None) -> AnalyzeResult:
        if not table.isTable or text.value not in table.dataType.names:
            raise ValueError("chunk_table takes a table and the name of its text column")
        schema = StructType([f for f in table.dataType.fields if f.name != text.value])
        return AnalyzeResult(schema.add("chunk_id", LongType()).add("chunk", StringType()))

    def eval(self, row: Row, text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Iterator[tuple]:
        body = row[text] or ""
        others = [row[name] for name in row.__fields__ if name != text]
        for k, (a, b) in enumerate(split_spans(body, size, overlap)):
            yield (*others, k, body[a:b])


def register(spark: SparkSession) -> None:
    """Make the table functions known to ``spark.sql``."""
    spark.udtf.register("chunk_table", udtf(ChunkTable))

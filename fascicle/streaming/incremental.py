"""Process only what has not been processed yet.

The jobs this package serves are batch jobs that skip work whose output exists. The streaming
form keeps that promise through the file source's own log: a run takes the files it has not
seen, writes their rows once and stops.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.joins import pending


def process_new_files(spark: SparkSession, source: str, schema: T.StructType, output: str, checkpoint: str,
                      transform: Callable[[DataFrame], DataFrame], fmt: str = "parquet",
                      pattern: str | None = None, files_per_trigger: int = 1000) -> int:
    """Run every file not seen by an earlier call through ``transform`` and append the rows.

    Input is taken in bounded micro-batches; an interrupted run resumes from ``checkpoint``,
    which must be on shared storage. Returns the number of input rows.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    counter = _InputRows()
    spark.streams.addListener(counter)
    query = (
        transform(reader.load(source)).writeStream.format("parquet").outputMode("append")
        .option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    try:
        query.awaitTermination()
        counter.wait_for_end(str(query.runId), 60)  # the listener hears of the end after the last batch
    finally:
        spark.streams.removeListener(counter)
    return counter.rows[str(query.runId)]


class _InputRows(StreamingQueryListener):
    """Input rows of every batch; a query itself remembers its latest batches only."""

    def __init__(self):
        self.rows: Counter[str] = Counter()
        self.ended: set[str] = set()
        self.news = threading.Condition()

    def wait_for_end(self, run: str, seconds: float) -> None:
        with self.news:
            self.news.wait_for(lambda: run in self.ended, seconds)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.rows[str(event.progress.runId)] += event.progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()


def process_pending(todo: DataFrame, done: DataFrame, key: str, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Batch form: only rows whose key has no output."""
    return transform(pending(todo, done, [key]))

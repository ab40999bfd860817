"""Streaming progress as audit rows."""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.schemas import RULE_COUNTS, STREAMING_AUDITS
from tidemark.sources.tables import read_or_empty


def _values(progress) -> tuple:
    sources = progress.sources
    return (
        str(progress.id),
        str(progress.runId),
        int(progress.batchId),
        progress.name,
        sources[0].description if sources else None,
        progress.sink.description,
        int(progress.numInputRows),
        int(progress.sink.numOutputRows),
        progress.timestamp,
    )


#: The name under which a stream observes its failures per rule.
RULES = "rules"


def _rule_values(progress) -> list[tuple]:
    seen = progress.observedMetrics.get(RULES)
    head = (str(progress.id), str(progress.runId), int(progress.batchId), progress.name)
    return [(*head, name, int(n)) for name, n in seen.asDict().items()] if seen else []


class ProgressLog(StreamingQueryListener):
    """Appends a row per progress report of every query to a Parquet folder.

    Reports arrive while the queries run, so none is lost however many there
    are.  Use it as a context: ``with ProgressLog(spark, path) as log``.
    Failures per rule that a stream observes on its way go to ``<path>.rules``,
    a row per batch and rule.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended = defaultdict(threading.Event)

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until every report of an ended query is in the log."""
        if not self.ended[str(query.runId)].wait(seconds):
            raise TimeoutError(f"no end of query {query.runId} was reported")

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, STREAMING_AUDITS)

    def read_rules(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}.rules", RULE_COUNTS)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = self.spark.createDataFrame([_values(event.progress)], STREAMING_AUDITS)
        row.coalesce(1).write.mode("append").parquet(self.path)
        if rules := _rule_values(event.progress):
            self.spark.createDataFrame(rules, RULE_COUNTS).coalesce(1).write.mode("append").parquet(f"{self.path}.rules")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

"""Counters taken in the main pass of a stream (AGG-9).

``counted`` adds an ``observe`` node to a streaming DataFrame: the counters are summed
while the batch flows to its sink, and come with the batch's progress event, where a
listener picks them up.  No second job reads the batch.  A sink that evaluates its batch
more than once counts it more than once.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from spindle.operators.joins import checked_broadcast


class Counters(StreamingQueryListener):
    """Collects the metrics named ``name``, one row per batch: the last one reported of a batch counts."""

    def __init__(self, name: str):
        self.name, self.by_batch, self._ended = name, {}, threading.Event()

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None and event.progress.numInputRows:
            self.by_batch[event.progress.batchId] = row

    def onQueryTerminated(self, event: Any) -> None:
        self._ended.set()

    def wait(self, seconds: float = 60.0) -> dict[int, Row]:
        """The rows by batch id, after the query has ended and all its events have come in."""
        if not self._ended.wait(seconds):
            raise TimeoutError(f"no end event of the query within {seconds} s")
        return dict(sorted(self.by_batch.items()))


def counted(stream: DataFrame, name: str, *counters: Column) -> DataFrame:
    """``stream`` with ``counters`` (aggregates) observed under ``name``."""
    return stream.observe(name, *counters)


def stopword_counters() -> list[Column]:
    """JON-2 / AGG-9 over flagged tokens: all tokens, and those in the stop list."""
    return [F.count(F.lit(1)).alias("n_tokens"), F.count_if(F.col("is_stop")).alias("n_stop")]


def flagged_tokens(words: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Tokens with ``is_stop``; on a stream the stop list is the static side of the join."""
    marks = stopwords.select("word").distinct().withColumn("marked", F.lit(True))
    return (words.join(checked_broadcast(marks, "word"), "word", "left")
            .withColumn("is_stop", F.col("marked").isNotNull()).drop("marked"))


def listening(df: DataFrame, counters: Counters, begin: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query of ``df``'s session with ``counters`` listening to it."""
    df.sparkSession.streams.addListener(counters)
    return begin()

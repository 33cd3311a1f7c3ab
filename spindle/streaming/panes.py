"""Sliding-window counts from panes (STR-4/5/6).

A window that slides by 60 s over 5 minutes puts every record into five windows.  Here
the stream counts each record once, in the pane of its time (the greatest common divisor
of length and slide), so the state store holds a fifth of the entries and no record is
copied; windows are sums of panes, made from the counted panes.
"""

from __future__ import annotations

import uuid
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.times import instant_to_ntz

LENGTH_S, SLIDE_S = 300, 60


def pane_seconds(length_s: int = LENGTH_S, slide_s: int = SLIDE_S) -> int:
    return gcd(length_s, slide_s)


def pane_counts(words: DataFrame, time_col: str = "event_time", length_s: int = LENGTH_S, slide_s: int = SLIDE_S,
                watermark: str | None = None) -> DataFrame:
    """Counts per word and pane: ``(pane, word, n)``, ``pane`` = its first second since the epoch.

    On a stream this is the stateful part (update mode); with ``watermark`` closed panes
    leave the state.
    """
    src = words.withWatermark(time_col, watermark) if watermark else words
    pane = F.window(time_col, f"{pane_seconds(length_s, slide_s)} seconds")
    return (src.groupBy(pane.alias("w"), "word").agg(F.count(F.lit(1)).alias("n"))
            .select(F.unix_seconds(F.col("w.start")).alias("pane"), "word", "n"))


def pane_counts_sql(words: DataFrame, time_col: str = "event_time", length_s: int = LENGTH_S, slide_s: int = SLIDE_S,
                    watermark: str | None = None) -> DataFrame:
    """STR-6: ``pane_counts`` written in SQL over a (streaming) temp view."""
    src = words.withWatermark(time_col, watermark) if watermark else words
    view, spark = f"stream_words_{uuid.uuid4().hex[:10]}", words.sparkSession
    src.createOrReplaceTempView(view)
    w = f"window({time_col}, '{pane_seconds(length_s, slide_s)} seconds')"
    try:
        return spark.sql(f"SELECT unix_seconds({w}.start) AS pane, word, count(*) AS n FROM {view} GROUP BY {w}, word")
    finally:
        spark.catalog.dropTempView(view)


def _window_starts(length_s: int, slide_s: int) -> str:
    """Starts of the windows that hold a whole pane; empty where windows leave gaps."""
    rest = length_s - pane_seconds(length_s, slide_s)
    last = f"pane - pmod(pane, {slide_s})"
    return (f"CASE WHEN pmod(pane, {slide_s}) <= {rest} THEN sequence({last} - {slide_s} * (({rest} - pmod(pane, {slide_s})) "
            f"DIV {slide_s}), {last}, {slide_s}L) ELSE array() END")


def _start_time(seconds: Column) -> Column:
    return instant_to_ntz(F.timestamp_seconds(seconds)).alias("window_start")


def windows_of_panes(panes: DataFrame, length_s: int = LENGTH_S, slide_s: int = SLIDE_S) -> DataFrame:
    """Sliding windows ``(window_start, word, n)`` as sums of counted panes."""
    opened = panes.select(F.explode(F.expr(_window_starts(length_s, slide_s))).alias("start"), "word", "n")
    return (opened.groupBy("start", "word").agg(F.sum("n").alias("n")).select(_start_time(F.col("start")), "word", "n"))


def windows_of_panes_sql(panes: DataFrame, length_s: int = LENGTH_S, slide_s: int = SLIDE_S) -> DataFrame:
    """``windows_of_panes`` in SQL."""
    view, spark = f"panes_{uuid.uuid4().hex[:10]}", panes.sparkSession
    panes.createOrReplaceTempView(view)
    try:
        summed = spark.sql(f"SELECT start, word, sum(n) AS n FROM {view} "
                           f"LATERAL VIEW explode({_window_starts(length_s, slide_s)}) w AS start GROUP BY start, word")
    finally:
        spark.catalog.dropTempView(view)
    return summed.select(_start_time(F.col("start")), "word", "n")

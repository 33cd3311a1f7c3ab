"""Unbounded line sources (SRC-5).

File-based sources are replayable (offsets are file names in the checkpoint), so
a restarted query neither loses nor repeats input.  The socket source keeps
nothing and is for demos only; it cannot recover after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spindle.sources.files import LINE_SCHEMA


def stream_lines(spark: SparkSession, path: str, fmt: str = "text",
                 max_files_per_trigger: int | None = None, schema=None,
                 options: dict[str, str] | None = None) -> DataFrame:
    """New files under ``path`` as a stream of lines (column ``value`` for text).

    ``fmt`` is ``text`` (one row per line) or a columnar format such as
    ``parquet`` with an explicit ``schema``.  ``max_files_per_trigger`` bounds the
    size of each micro-batch.
    """
    reader = spark.readStream.format(fmt).schema(schema or LINE_SCHEMA).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines read from a TCP socket (not fault tolerant; no replay after restart)."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()

"""Starting streaming queries (STR-1, STR-9, STR-10, STR-11).

A query is always started with a checkpoint location, so a restart on the same
location resumes source offsets and operator state (recover-or-create).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spindle.session import ROCKSDB_PROVIDER

BatchFn = Callable[[DataFrame, int], None]

CHANGELOG_KEY = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def batch_time_ms() -> Column:
    """STR-10: the micro-batch's time in epoch milliseconds.

    Inside ``foreachBatch`` every batch is a separate query, so
    ``current_timestamp()`` is fixed for the whole batch.
    """
    return F.unix_millis(F.current_timestamp())


def stream_session(spark: SparkSession, state_partitions: int | None = None, idle_batches: bool = True) -> SparkSession:
    """A session of its own for a stream: RocksDB state with changelog checkpoints, and a number of
    state partitions that stateful queries of a new checkpoint keep for life.

    ``idle_batches=False`` leaves out the batch without input that follows each batch to move
    the watermark: in update mode it emits nothing, and the next batch drops the closed state.

    The caller's session keeps its settings; both share the cluster and the files.
    """
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    own.conf.set(CHANGELOG_KEY, "true")
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle_batches).lower())
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def start(df: DataFrame, checkpoint: str, *, foreach_batch: BatchFn | None = None,
          output_mode: str = "append", processing_time: str | None = None,
          available_now: bool = False, fmt: str | None = None, options: dict | None = None,
          query_name: str | None = None) -> StreamingQuery:
    """Start ``df`` as a streaming query.

    ``processing_time`` (e.g. ``"60 seconds"``) gives a fixed micro-batch cadence;
    ``available_now`` processes what is there and stops; with neither, batches follow
    each other as input arrives.
    Either a ``foreach_batch`` function or a sink ``fmt`` is used.
    """
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif fmt is not None:
        w = w.format(fmt)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query to finish; re-raise its failure."""
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout_s}s")
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")

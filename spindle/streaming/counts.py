"""Streaming word counts (STR-2..8, AGG-10, SRC-6).

* per batch (stateless, counts reset every batch) - inside ``foreachBatch``;
* SQL over each batch through a temp view;
* sliding event-time windows, DataFrame and SQL forms, bounded by a watermark;
* running count per record, from a log of totals keyed by batch id, with map-side
  pre-aggregation so a hot word never ships its raw rows to one task;
* cumulative snapshot of all counts (streaming aggregate in the state store).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.functions.times import instant_to_ntz, ntz_to_instant
from spindle.functions.tokens import space_tokens
from spindle.session import cluster_cores
from spindle.sources.folders import list_files
from spindle.streaming.sinks import write_batch_partition

# Largest run of consecutive running totals emitted as one row before expansion;
# bounds the array built per row when a hot word's totals are generated.
RANGE_CHUNK = 65_536


def stream_words(lines: DataFrame, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-1 over a (streaming or batch) line table: one row per token, column ``word``.

    ``keep`` columns (e.g. an event time or a slice tag) are carried to each token.
    """
    return lines.select(*keep, F.explode(space_tokens(F.col(col))).alias("word"))


def count_per_batch(words: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """STR-2: counts of one micro-batch (call inside ``foreachBatch``), column ``n``."""
    return words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))


def sql_per_batch(words: DataFrame, sql_template: str) -> DataFrame:
    """STR-3 / AGG-10: run SQL over one micro-batch through a temp view.

    ``sql_template`` names the view ``{view}``; the batch's own session runs it.
    """
    view = f"words_{uuid.uuid4().hex[:10]}"
    words.createOrReplaceTempView(view)
    try:
        return words.sparkSession.sql(sql_template.format(view=view))
    finally:
        # the plan is analysed already; dropping the name does not affect the result
        words.sparkSession.catalog.dropTempView(view)


def with_event_time(df: DataFrame, ts_col: str, out: str = "event_time") -> DataFrame:
    """Add an instant column for watermarking; ``timestamp_ntz`` is read as UTC."""
    field = df.schema[ts_col].dataType
    col = F.col(ts_col)
    return df.withColumn(out, ntz_to_instant(col) if isinstance(field, T.TimestampNTZType) else col)


def with_arrival_time(df: DataFrame, out: str = "event_time") -> DataFrame:
    """Stamp rows with their arrival time, for windows over processing time.

    In a stream, ``current_timestamp()`` is the micro-batch's time, so every row
    of a batch falls into the windows of the batch that read it.
    """
    return df.withColumn(out, F.current_timestamp())


def sliding_counts(words: DataFrame, time_col: str = "event_time", length: str = "5 minutes",
                   slide: str = "60 seconds", watermark: str | None = None,
                   keys: tuple[str, ...] = (), start_time: str | None = None) -> DataFrame:
    """STR-4/5: word counts per sliding window ``[start, start+length)``.

    With ``watermark`` the state of closed windows is dropped (append/update
    modes); the watermark must exceed the input's event-time disorder.
    ``start_time`` shifts the window alignment (e.g. ``"30 seconds"``).
    """
    src = words.withWatermark(time_col, watermark) if watermark else words
    win = (F.window(time_col, length, slide, start_time) if start_time
           else F.window(time_col, length, slide))
    agg = src.groupBy(win.alias("w"), *keys, "word").agg(
        F.count(F.lit(1)).alias("n"))
    return agg.select(instant_to_ntz(F.col("w.start")).alias("window_start"), *keys, "word", "n")


def sliding_counts_sql(words: DataFrame, time_col: str = "event_time", length: str = "5 minutes",
                       slide: str = "60 seconds", watermark: str | None = None) -> DataFrame:
    """STR-6: the same windowed count written in SQL over a (streaming) temp view."""
    src = words.withWatermark(time_col, watermark) if watermark else words
    view = f"stream_words_{uuid.uuid4().hex[:10]}"
    src.createOrReplaceTempView(view)
    spark = words.sparkSession
    w = f"window({time_col}, '{length}', '{slide}')"
    try:
        out = spark.sql(f"SELECT {w}.start AS w_start, word, count(*) AS n "
                        f"FROM {view} GROUP BY {w}, word")
    finally:
        spark.catalog.dropTempView(view)
    return out.select(instant_to_ntz(F.col("w_start")).alias("window_start"), "word", "n")


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word string, prev long, n long, total long, batch_id long").parquet(path)


def update_totals(words: DataFrame, batch_id: int, totals_path: str, full_every: int = 16) -> DataFrame:
    """Add a micro-batch to the running totals; ``(word, prev, n, total)`` of its words.

    Call inside ``foreachBatch``.  The batch is counted (partial counts before the
    shuffle), joined with the latest totals of earlier batches, and the new totals are
    written under its batch id into the log at ``totals_path``.  Every ``full_every``-th
    batch writes all words, so a lookup reads the last full batch and the few after it.
    A replayed batch looks only at batches before its own and rewrites its partition.
    """
    spark = words.sparkSession
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    if batch_id:
        last_full = (batch_id - 1) // full_every * full_every
        before = (_log(spark, totals_path).filter(F.col("batch_id").between(last_full, batch_id - 1))
                  .groupBy("word").agg(F.max("total").alias("prev")))
        joined = counted.join(before, "word", "left" if batch_id % full_every else "full")
    else:
        joined = counted.withColumn("prev", F.lit(None).cast("long"))
    prev, n = F.coalesce("prev", F.lit(0)), F.coalesce("n", F.lit(0))
    write_batch_partition(joined.select("word", prev.alias("prev"), n.alias("n"), (prev + n).alias("total")),
                          totals_path, batch_id)
    return (_log(spark, totals_path).filter((F.col("batch_id") == batch_id) & (F.col("n") > 0))
            .select("word", "prev", "n", "total"))


def running_counts(words: DataFrame, batch_id: int, totals_path: str, full_every: int = 16,
                   spread_partitions: int | None = None) -> DataFrame:
    """STR-7: one ``(word, total)`` row per token of a micro-batch, ``total`` = running count so far.

    Totals come from :func:`update_totals`.  A hot word's totals are expanded from ranges
    of at most ``RANGE_CHUNK`` values, spread over ``spread_partitions`` tasks (by default
    one per core).  Within a batch the order of a word's totals is not defined.
    """
    new = update_totals(words, batch_id, totals_path, full_every)
    low = F.explode(F.sequence(F.col("prev") + 1, F.col("total"), F.lit(RANGE_CHUNK).cast("long")))
    ranges = (new.select("word", "total", low.alias("low"))
              .repartition(spread_partitions or cluster_cores(words.sparkSession)))
    high = F.least(F.col("total"), F.col("low") + (RANGE_CHUNK - 1))
    return ranges.select("word", F.explode(F.sequence(F.col("low"), high)).alias("total"))


def running_totals(spark: SparkSession, totals_path: str) -> DataFrame:
    """STR-8: the latest ``(word, total)`` of every word seen, from the running-count log."""
    return _log(spark, totals_path).groupBy("word").agg(F.max("total").alias("total"))


def count_snapshot(words: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """STR-8: cumulative ``(word, total)``; in update mode each batch yields the words it changed.

    ``keep`` columns carry their latest (greatest) value, e.g. the slice that changed the word.
    """
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("total"), *(F.max(c).alias(c) for c in keep))


def snapshots(log: DataFrame, tag: str, last: int) -> DataFrame:
    """All words' totals after every batch ``tag`` up to ``last``, from an update-mode log (word, total, tag)."""
    after = log.select("word", "total", F.explode(F.sequence(F.col(tag), F.lit(last).cast(log.schema[tag].dataType))).alias(tag))
    return after.groupBy(tag, "word").agg(F.max("total").alias("total"))


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The id of the last committed batch of a query's checkpoint, -1 if there is none."""
    names = list_files(spark, f"{checkpoint}/commits")
    return max((int(n) for n in names if n.isdigit()), default=-1)


def state_totals(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """STR-8 read-back: ``(word, total)`` from the state of a ``count_snapshot`` query in ``checkpoint``.

    ``batch_id`` is the batch after which the state is read (by default the last one); the
    state store rebuilds it from its snapshots and changelogs, as far as those are retained.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    return state.select(F.col("key.word").alias("word"), F.col("value.count").alias("total"))


def state_snapshots(spark: SparkSession, checkpoint: str, batches: list[int]) -> DataFrame:
    """STR-8: ``(batch, word, total)``, the state after each of ``batches``, read from the state store."""
    if not batches:
        return spark.createDataFrame([], "batch long, word string, total long")
    after = [state_totals(spark, checkpoint, b).select(F.lit(b).cast("long").alias("batch"), "word", "total") for b in batches]
    return reduce(DataFrame.unionByName, after)

"""Streaming catalogue queries.

Each query replays a table as a stream, slice by slice, and returns a batch DataFrame
read from the sink it wrote.  Prose queries replay the lines of ``documents`` (slice =
``doc_id mod 4``), the others ``events``, a line being the event type (slice =
``event_id mod 4``; for windows a span of days, so that event time moves on).  Together
the slices are the whole table, and a slice is one micro-batch of one running query.
``stream_resumed_counts`` stops and restarts half way.  All folders live under the
session's checkpoint root; replayed input and checkpoints are removed at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spindle.functions.times import ntz_epoch_millis
from spindle.functions.tokens import clean_tokens
from spindle.plans.inputs import catalog_stopwords, sliced_prose_lines
from spindle.session import cluster_cores, scratch_path
from spindle.sources.folders import remove_folder
from spindle.sources.tables import load_table
from spindle.streaming import counts, observed, panes, records, sinks
from spindle.streaming.replay import Replay
from spindle.streaming.run import batch_time_ms, start, stream_session

N_SLICES = 4
# Windows: events are replayed in spans of this many days, and the watermark waits this
# long; a later span holds later events only, so none is late and closed windows go.
SLICE_DAYS = 8
WATERMARK = "10 minutes"

Runs = Callable[[list[int]], list[list[int]]]
StartFn = Callable[[DataFrame, str], StreamingQuery]


def one_run(slices: list[int]) -> list[list[int]]:
    return [slices]


def two_runs(slices: list[int]) -> list[list[int]]:
    return [slices[:len(slices) // 2], slices[len(slices) // 2:]]


def event_lines(spark: SparkSession, sf_dir: str, wanted: Column | None = None) -> DataFrame:
    """Events, or those of them where ``wanted`` holds."""
    ev = load_table(spark, sf_dir, "events")
    ev = ev if wanted is None else ev.filter(wanted)
    return ev.select(F.pmod("event_id", F.lit(N_SLICES)).cast("int").alias("slice"),
                     "event_id", "ts", F.col("event_type").alias("value"))


def timed_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in slices of ``SLICE_DAYS`` days, in the order of time."""
    day = F.floor(ntz_epoch_millis(F.col("ts")) / (86_400_000 * SLICE_DAYS))
    return event_lines(spark, sf_dir).withColumn("slice", day.cast("int"))


def replayed(spark: SparkSession, source: DataFrame, name: str, start_fn: StartFn, runs: Runs = one_run,
             afterwards: Callable[[str], None] | None = None, idle_batches: bool = True) -> None:
    """Run ``start_fn(stream, checkpoint)`` over all slices of ``source``; ``afterwards(checkpoint)`` still sees it."""
    session = stream_session(spark, cluster_cores(spark), idle_batches)
    root = scratch_path(spark, name)
    replay = Replay(session, source, "slice", f"{root}/input")
    for slices in runs(replay.slices):
        replay.run(slices, lambda stream: start_fn(stream, f"{root}/checkpoint"))
    if afterwards:
        afterwards(f"{root}/checkpoint")
    remove_folder(spark, root)


def _per_batch_dirs(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    prefix = scratch_path(spark, name) + "/out"

    def per_batch(df: DataFrame, batch_id: int) -> None:
        sinks.save_batch_dir(counts.count_per_batch(df, keys=("slice",)), prefix, batch_id)

    replayed(spark, lines, name, lambda s, ck: start(counts.stream_words(s, keep=("slice",)), ck, foreach_batch=per_batch))
    return sinks.read_batch_dirs(spark, prefix, "slice int, word string, n long")


def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1/2/10/11 + SNK-2/7: per-batch counts saved to one folder per batch."""
    return _per_batch_dirs(spark, event_lines(spark, sf_dir), "batch-counts")


def stream_prose_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-2 + SNK-2 over prose: the words of each batch of lines."""
    return _per_batch_dirs(spark, sliced_prose_lines(spark, sf_dir, N_SLICES), "prose-batch-counts")


def stream_batch_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-10: rows and distinct batch times of every batch; all rows of a batch see one time."""
    out = scratch_path(spark, "batch-times")
    replayed(spark, event_lines(spark, sf_dir), "batch-times", lambda s, ck: start(
        counts.stream_words(s, keep=("slice",)), ck, foreach_batch=lambda df, bid: sinks.write_batch_partition(
            df.select("slice", batch_time_ms().alias("time_ms")), out, bid)))
    times = spark.read.parquet(out)
    return times.groupBy("slice").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("time_ms").alias("n_times"))


def _sql_counts(spark: SparkSession, lines: DataFrame, name: str) -> DataFrame:
    out = scratch_path(spark, name)
    sql = "SELECT slice, word, count(*) AS total FROM {view} GROUP BY slice, word"

    def per_batch(df: DataFrame, batch_id: int) -> None:
        sinks.write_batch_partition(counts.sql_per_batch(df, sql), out, batch_id)

    replayed(spark, lines, name, lambda s, ck: start(counts.stream_words(s, keep=("slice",)), ck, foreach_batch=per_batch))
    return spark.read.parquet(out).select("slice", "word", "total")


def stream_sql_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-3 + SRC-6 + AGG-10: each batch counted by SQL over a temp view."""
    return _sql_counts(spark, event_lines(spark, sf_dir), "sql-counts")


def stream_prose_sql_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-3 over prose."""
    return _sql_counts(spark, sliced_prose_lines(spark, sf_dir, N_SLICES), "prose-sql-counts")


def _windowed(spark: SparkSession, sf_dir: str, name: str, count: Callable[..., DataFrame],
              combine: Callable[[DataFrame], DataFrame]) -> DataFrame:
    out = scratch_path(spark, name)

    def begin(stream: DataFrame, checkpoint: str) -> StreamingQuery:
        words = counts.stream_words(counts.with_event_time(stream, "ts"), keep=("event_time",))
        return start(count(words, watermark=WATERMARK), checkpoint, output_mode="update",
                     foreach_batch=lambda df, bid: sinks.write_batch_partition(df, out, bid))

    replayed(spark, timed_event_lines(spark, sf_dir), name, begin, idle_batches=False)
    return combine(sinks.latest_per_key(spark, out, ("pane", "word"), "n"))


def stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-4/5: 5-minute windows sliding by 60 s, from panes counted once in update mode."""
    return _windowed(spark, sf_dir, "sliding-counts", panes.pane_counts, panes.windows_of_panes)


def stream_sliding_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-6: the same panes and windows through SQL on temp views."""
    return _windowed(spark, sf_dir, "sliding-counts-sql", panes.pane_counts_sql, panes.windows_of_panes_sql)


def stream_arrival_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-4 over processing time: a word's counts in all windows that its records arrived in, and those windows' number.

    A record is in five windows; a batch's records arrive together.
    """
    out = scratch_path(spark, "arrival-windows")

    def begin(stream: DataFrame, checkpoint: str) -> StreamingQuery:
        words = counts.stream_words(counts.with_arrival_time(stream), keep=("event_time", "slice"))
        return start(words, checkpoint, foreach_batch=lambda df, bid: sinks.write_batch_partition(
            counts.sliding_counts(df, keys=("slice",)), out, bid))

    replayed(spark, event_lines(spark, sf_dir), "arrival-windows", begin)
    return (spark.read.parquet(out).groupBy("slice", "word")
            .agg(F.countDistinct("window_start").alias("n_windows"), F.sum("n").alias("n")))


CADENCE_MS = 400


def stream_cadence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1 with a fixed cadence: rows per batch, and whether the batch began in a tick of its own."""
    out = scratch_path(spark, "cadence-counts")
    replayed(spark, event_lines(spark, sf_dir), "cadence-counts", lambda s, ck: start(
        counts.stream_words(s, keep=("slice",)), ck, processing_time=f"{CADENCE_MS} milliseconds",
        foreach_batch=lambda df, bid: sinks.write_batch_partition(
            counts.count_per_batch(df, keys=("slice",)).withColumn("tick", F.floor(batch_time_ms() / CADENCE_MS)), out, bid)))
    rows = spark.read.parquet(out)
    shared = rows.groupBy("tick").agg(F.countDistinct("slice").alias("batches"))
    return (rows.join(shared, "tick").groupBy("slice")
            .agg(F.sum("n").alias("n_rows"), (F.max("batches") == 1).alias("own_tick")))


def stream_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-7: a running total for every record."""
    out, totals = scratch_path(spark, "running-counts"), scratch_path(spark, "running-totals")
    replayed(spark, event_lines(spark, sf_dir), "running", lambda s, ck: start(
        counts.stream_words(s), ck, foreach_batch=lambda df, bid: sinks.write_batch_partition(
            counts.running_counts(df, bid, totals), out, bid)))
    return spark.read.parquet(out).select("word", "total")


def stream_record_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-7 by record: each event with its word's running total, batch by batch in the order of event_id."""
    out, path = scratch_path(spark, "record-totals"), scratch_path(spark, "record-state")
    replayed(spark, event_lines(spark, sf_dir), "record-totals", lambda s, ck: start(
        records.record_words(s, ("event_id",)), ck, foreach_batch=lambda df, bid: sinks.write_batch_partition(
            records.record_totals(df, bid, path, ("event_id", "pos")), out, bid)))
    return spark.read.parquet(out).select("event_id", "word", "total")


def stream_state_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STF-1: two state functions of the caller's in one: the running sum of the mapWithState program, and the
    number of batches and the largest count of one batch."""
    path = scratch_path(spark, "state-function")

    def update(old: Column, new: Column) -> Column:
        count = new["n"]
        return F.struct((F.coalesce(old["total"], F.lit(0)) + count).alias("total"),
                        (F.coalesce(old["batches"], F.lit(0)) + 1).alias("batches"),
                        F.greatest(F.coalesce(old["most"], F.lit(0)), count).alias("most"))

    replayed(spark, event_lines(spark, sf_dir), "state-function", lambda s, ck: start(
        counts.stream_words(s), ck, foreach_batch=lambda df, bid: records.update_state(
            df, bid, path, "word", F.struct(F.count(F.lit(1)).alias("n")), update,
            "struct<total: long, batches: long, most: long>", full_every=2)), two_runs)
    log = spark.read.schema("word string, state struct<total: long, batches: long, most: long>, batch_id long").parquet(path)
    return records.latest_states(log).select("word", "state.*")


def stream_prose_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-7 over prose: the running total of every word, by the slice it came in."""
    out, totals = scratch_path(spark, "prose-running"), scratch_path(spark, "prose-totals")

    def per_batch(df: DataFrame, batch_id: int) -> None:
        first = df.select("slice").first()  # a batch is one slice
        if first is not None:
            rows = counts.running_counts(df, batch_id, totals).withColumn("slice", F.lit(first["slice"]).cast("int"))
            sinks.write_batch_partition(rows, out, batch_id)

    replayed(spark, sliced_prose_lines(spark, sf_dir, N_SLICES), "prose-running", lambda s, ck: start(
        counts.stream_words(s, keep=("slice",)), ck, foreach_batch=per_batch))
    return spark.read.parquet(out).select("slice", "word", "total")


def stream_resumed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-8/9: totals after a stop and a restart on one checkpoint."""
    totals = scratch_path(spark, "resumed-totals")
    replayed(spark, event_lines(spark, sf_dir), "resumed", lambda s, ck: start(
        counts.stream_words(s), ck, foreach_batch=lambda df, bid: counts.update_totals(df, bid, totals)), two_runs)
    return counts.running_totals(spark, totals)


def _snapshot_log(spark: SparkSession, lines: DataFrame, name: str, runs: Runs = one_run,
                  afterwards: Callable[[str], None] | None = None) -> DataFrame:
    """The update log of the cumulative counts: each batch writes the words it changed."""
    out = scratch_path(spark, name)
    replayed(spark, lines, name, lambda s, ck: start(
        counts.count_snapshot(counts.stream_words(s, keep=("slice",)), keep=("slice",)), ck, output_mode="update",
        foreach_batch=lambda df, bid: sinks.write_batch_partition(df, out, bid)), runs, afterwards)
    return spark.read.parquet(out)


def stream_count_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-8: cumulative counts of all words after the last batch."""
    log = _snapshot_log(spark, event_lines(spark, sf_dir), "count-snapshot")
    return log.groupBy("word").agg(F.max_by("total", "batch_id").alias("total"))


def stream_prose_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-8 over prose: cumulative counts of all words after every slice."""
    log = _snapshot_log(spark, sliced_prose_lines(spark, sf_dir, N_SLICES), "prose-snapshot")
    return counts.snapshots(log, "slice", N_SLICES - 1)


def stream_resumed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-9: a stateful aggregate stopped half way and restarted; its state comes back from the checkpoint's changelog.

    The log holds what each batch changed, so totals are whole only if the second run
    found the first one's state.
    """
    log = _snapshot_log(spark, event_lines(spark, sf_dir), "resumed-state", two_runs)
    return log.groupBy("word").agg(F.max_by("total", "batch_id").alias("total"))


def stream_state_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-8: all words' totals after every batch, read from the state store of the stopped query."""
    out = scratch_path(spark, "state-snapshots")

    def read(checkpoint: str) -> None:
        last = counts.last_batch(spark, checkpoint)
        counts.state_snapshots(spark, checkpoint, list(range(last + 1))).write.parquet(out)

    _snapshot_log(spark, event_lines(spark, sf_dir), "state-snapshots-log", afterwards=read)
    return spark.read.schema("batch long, word string, total long").parquet(out)


def stream_stopword_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-9 in a stream: tokens and stop words of every batch, observed while the batch is counted into its sink."""
    out, stop = scratch_path(spark, "stopword-counters"), catalog_stopwords(spark)
    listener = observed.Counters("stopwords")

    def begin(stream: DataFrame, checkpoint: str) -> StreamingQuery:
        tokens = stream.select("slice", F.explode(clean_tokens(F.col("value"))).alias("word"))
        flagged = observed.counted(observed.flagged_tokens(tokens, stop), "stopwords", F.max("slice").alias("slice"),
                                   *observed.stopword_counters())
        return observed.listening(stream, listener, lambda: start(
            flagged, checkpoint, foreach_batch=lambda df, bid: sinks.write_batch_partition(
                counts.count_per_batch(df.filter(~F.col("is_stop")), keys=("slice",)), out, bid)))

    replayed(spark, sliced_prose_lines(spark, sf_dir, N_SLICES), "stopword-counters", begin)
    seen = [(r["slice"], r["n_tokens"], r["n_stop"]) for r in listener.wait().values()]  # a row per batch
    kept = spark.read.parquet(out).groupBy("slice").agg(F.sum("n").alias("n_kept"))
    return spark.createDataFrame(seen, "slice int, n_tokens long, n_stop long").join(kept, "slice", "left")


def sink_compacted_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5: two programs write one counter table, which is folded into snapshots between their batches.

    One counts event types, the other the same types of users with an even id.  After its
    last batch each program replays a batch that a snapshot holds already.
    """
    path = scratch_path(spark, "compacted")

    def run(lines: DataFrame, writer: str) -> None:
        def per_batch(df: DataFrame, batch_id: int) -> None:
            counted = counts.count_per_batch(df)
            sinks.increment_counts(counted, path, batch_id, writer=writer)
            if batch_id % 2:
                sinks.compact_counters(spark, path)
                sinks.increment_counts(counted, path, batch_id, writer=writer)

        replayed(spark, lines, f"compacted-{writer}", lambda s, ck: start(counts.stream_words(s), ck, foreach_batch=per_batch))

    run(event_lines(spark, sf_dir), "all")
    run(event_lines(spark, sf_dir, F.col("user_id") % 2 == 0), "even")
    return sinks.counter_totals(spark, path).select(F.col("key").alias("word"), "total")


def sink_counter_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5/8: per-batch counts applied as idempotent increments to a keyed counter table."""
    path = scratch_path(spark, "counters")
    replayed(spark, event_lines(spark, sf_dir), "counter-sink", lambda s, ck: start(
        counts.stream_words(s), ck, foreach_batch=lambda df, bid: sinks.increment_counts(
            counts.count_per_batch(df), path, bid, writer="events")))
    return sinks.counter_totals(spark, path).select(F.col("key").alias("word"), "total")


def sink_timed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6/8: per-batch counts keyed by (time_ms, word); time = latest event time of the batch."""
    path = scratch_path(spark, "timed-counts")

    def per_batch(df: DataFrame, batch_id: int) -> None:
        agg = (df.groupBy("word")
                 .agg(F.count(F.lit(1)).alias("n"), F.max(ntz_epoch_millis(F.col("ts"))).alias("t"))
                 .persist())
        try:
            latest = agg.agg(F.max("t")).first()[0]  # one scalar per batch
            if latest is not None:
                sinks.append_timed_counts(agg.withColumn("time_ms", F.lit(latest)), path, batch_id, writer="events")
        finally:
            agg.unpersist()

    replayed(spark, event_lines(spark, sf_dir), "timed-sink", lambda s, ck: start(
        counts.stream_words(s, keep=("ts",)), ck, foreach_batch=per_batch))
    return sinks.timed_cells(spark, path)


STREAM_QUERIES = {
    "stream_batch_counts": stream_batch_counts,
    "stream_batch_times": stream_batch_times,
    "stream_sql_counts": stream_sql_counts,
    "stream_prose_batch_counts": stream_prose_batch_counts,
    "stream_prose_sql_counts": stream_prose_sql_counts,
    "stream_sliding_counts": stream_sliding_counts,
    "stream_sliding_counts_sql": stream_sliding_counts_sql,
    "stream_arrival_windows": stream_arrival_windows,
    "stream_cadence_counts": stream_cadence_counts,
    "stream_running_counts": stream_running_counts,
    "stream_record_totals": stream_record_totals,
    "stream_state_function": stream_state_function,
    "stream_prose_running": stream_prose_running,
    "stream_resumed_counts": stream_resumed_counts,
    "stream_resumed_state": stream_resumed_state,
    "stream_count_snapshot": stream_count_snapshot,
    "stream_state_snapshots": stream_state_snapshots,
    "stream_stopword_counters": stream_stopword_counters,
    "stream_prose_snapshot": stream_prose_snapshot,
    "sink_counter_totals": sink_counter_totals,
    "sink_compacted_totals": sink_compacted_totals,
    "sink_timed_counts": sink_timed_counts,
}

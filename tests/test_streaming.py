"""Streaming operators on three tiny files: per batch, SQL, running, snapshot, restart."""

from pyspark.sql import functions as F

from spindle.streaming import counts, sinks
from spindle.streaming.replay import Replay
from spindle.streaming.run import start, stream_session

FILES = ["a a b", "a c\n", "a b d"]


def _source(spark, files):
    rows = []
    for i, text in enumerate(files):
        for line in text.split("\n"):
            rows.append((i, line))
    return spark.createDataFrame(rows, "slice int, value string")


def _by_batch(spark, path, cols):
    out = {}
    for r in spark.read.parquet(path).collect():
        out.setdefault(r.batch_id, []).append(tuple(r[c] for c in cols))
    return {k: sorted(v) for k, v in out.items()}


def test_per_batch_and_sql_counts(spark, tmp_dir):
    out, out_sql, prefix = f"{tmp_dir}/pb", f"{tmp_dir}/sql", f"{tmp_dir}/dirs/out"

    def per_batch(df, bid):
        sinks.write_batch_partition(counts.count_per_batch(df), out, bid)
        sinks.write_batch_partition(counts.sql_per_batch(
            df, "SELECT word, count(*) AS total FROM {view} GROUP BY word"), out_sql, bid)
        sinks.save_batch_dir(counts.count_per_batch(df), prefix, bid)

    replay = Replay(spark, _source(spark, FILES[:2]), "slice", f"{tmp_dir}/in")
    replay.run([0, 1], lambda s: start(counts.stream_words(s), f"{tmp_dir}/ck", foreach_batch=per_batch))
    expected = {0: [("a", 2), ("b", 1)], 1: [("", 1), ("a", 1), ("c", 1)]}
    assert _by_batch(spark, out, ["word", "n"]) == expected
    assert _by_batch(spark, out_sql, ["word", "total"]) == expected
    lines = sorted(r.value for r in spark.read.text(f"{prefix}-1").collect())
    assert lines == ["\t1", "a\t1", "c\t1"]
    back = sorted(tuple(r) for r in sinks.read_batch_dirs(spark, prefix, "word string, n long").collect())
    assert back == [("", 1), ("a", 1), ("a", 2), ("b", 1), ("c", 1)]


def test_running_counts_snapshot_and_restart(spark, tmp_dir):
    out, log, snap, ck = f"{tmp_dir}/run", f"{tmp_dir}/totals", f"{tmp_dir}/snap", f"{tmp_dir}/ck"

    def running(stream):
        return start(counts.stream_words(stream), ck, foreach_batch=lambda df, bid: sinks.write_batch_partition(
            counts.running_counts(df, bid, log, spread_partitions=4), out, bid))

    def snapshot(stream):
        words = counts.stream_words(stream, keep=("slice",))
        return start(counts.count_snapshot(words, keep=("slice",)), ck + "-snap", output_mode="update",
                     foreach_batch=lambda df, bid: sinks.write_batch_partition(df, snap, bid))

    for name, begin in (("a", running), ("b", snapshot)):
        replay = Replay(stream_session(spark, 4), _source(spark, FILES), "slice", f"{tmp_dir}/in-{name}")
        replay.run([0, 1], begin)  # first program run: two files
        replay.run([2], begin)  # second program run on the same checkpoint: the third file

    assert _by_batch(spark, out, ["word", "total"]) == {
        0: [("a", 1), ("a", 2), ("b", 1)],
        1: [("", 1), ("a", 3), ("c", 1)],
        2: [("a", 4), ("b", 2), ("d", 1)],
    }
    final = [("", 1), ("a", 4), ("b", 2), ("c", 1), ("d", 1)]
    assert sorted(tuple(r) for r in counts.running_totals(spark, log).collect()) == final
    assert sorted(tuple(r) for r in counts.state_totals(spark, ck + "-snap").collect()) == final
    after = counts.snapshots(spark.read.parquet(snap), "slice", 2)
    assert sorted((r.word, r.total) for r in after.collect() if r.slice == 1) == [("", 1), ("a", 3), ("b", 1), ("c", 1)]
    assert sorted((r.word, r.total) for r in after.collect() if r.slice == 2) == final


def test_running_counts_hot_word_chunks(spark, tmp_dir, monkeypatch):
    """A word far larger than one range chunk is expanded in pieces, totals 1..n."""
    monkeypatch.setattr(counts, "RANGE_CHUNK", 7)
    words = spark.range(0, 100, 1, 4).select(F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("word"))
    got = counts.running_counts(words, 0, f"{tmp_dir}/totals", spread_partitions=3)
    assert sorted(r.total for r in got.filter("word = 'hot'").collect()) == list(range(1, 91))
    assert sorted(r.total for r in got.filter("word = 'cold'").collect()) == list(range(1, 11))


def test_a_slice_is_one_batch_of_many_tasks(spark, tmp_dir):
    """A slice of 12 files is read in one micro-batch by more than one task."""
    source = spark.range(0, 1200, 1, 12).select(F.pmod("id", F.lit(2)).cast("int").alias("slice"),
                                                F.concat(F.lit("w"), F.col("id")).alias("value"))
    seen = {}

    def per_batch(df, bid):
        seen[bid] = (df.rdd.getNumPartitions(), df.count())

    replay = Replay(stream_session(spark, 4), source, "slice", f"{tmp_dir}/in")
    replay.run(replay.slices, lambda s: start(counts.stream_words(s), f"{tmp_dir}/ck", foreach_batch=per_batch))
    assert sorted(seen) == [0, 1]
    assert all(tasks > 1 and rows == 600 for tasks, rows in seen.values())


def test_rows_without_a_slice_are_replayed(spark, tmp_dir):
    rows = [(0, "a"), (None, "b"), (1, "c")]
    replay = Replay(spark, spark.createDataFrame(rows, "slice int, value string"), "slice", f"{tmp_dir}/in")
    out = f"{tmp_dir}/out"
    replay.run(replay.slices, lambda s: start(counts.stream_words(s), f"{tmp_dir}/ck", foreach_batch=lambda df, bid:
               sinks.write_batch_partition(counts.count_per_batch(df), out, bid)))
    assert _by_batch(spark, out, ["word", "n"]) == {0: [("a", 1), ("b", 1)], 1: [("c", 1)]}


def test_sliding_windows_drop_closed_state_and_no_late_rows(spark, tmp_dir):
    """Replaying events in the order of time gives the batch windows, with state evicted on the way."""
    from spindle.plans.stream import WATERMARK, timed_event_lines
    events = timed_event_lines(spark, "/root/testdata/sf0.001")
    out, queries = f"{tmp_dir}/win", []

    def begin(stream):
        words = counts.stream_words(counts.with_event_time(stream, "ts"), keep=("event_time",))
        queries.append(start(counts.sliding_counts(words, watermark=WATERMARK), f"{tmp_dir}/ck", output_mode="update",
                             foreach_batch=lambda df, bid: sinks.write_batch_partition(df, out, bid)))
        return queries[0]

    replay = Replay(stream_session(spark, 4), events, "slice", f"{tmp_dir}/in")
    assert len(replay.slices) > 2
    replay.run(replay.slices, begin)
    states = [op for p in queries[0].recentProgress for op in p["stateOperators"]]
    assert sum(op["numRowsRemoved"] for op in states) > 0
    assert sum(op["numRowsDroppedByWatermark"] for op in states) == 0
    assert min(op["numRowsTotal"] for op in states[1:]) < sum(op["numRowsUpdated"] for op in states)
    streamed = sorted(tuple(r) for r in sinks.latest_per_key(spark, out, ("window_start", "word"), "n")
                      .select("window_start", "word", "n").collect())
    batch_words = counts.stream_words(counts.with_event_time(events, "ts"), keep=("event_time",))
    batch = sorted(tuple(r) for r in counts.sliding_counts(batch_words).collect())
    assert streamed == batch and len(batch) > 0


def test_streams_leave_the_callers_session_alone(spark):
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    own = stream_session(spark, 3)
    assert own.conf.get(key) == "3" and spark.conf.get(key) == before


def test_event_time_is_session_zone_free(spark):
    """timestamp_ntz wall times map to the same UTC instants under any session zone."""
    from spindle.functions.times import instant_to_ntz, ntz_epoch_millis, ntz_to_instant
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.123456' AS ts")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = df.select(F.unix_micros(ntz_to_instant(F.col("ts"))).alias("us"),
                      instant_to_ntz(ntz_to_instant(F.col("ts"))).alias("back"),
                      ntz_epoch_millis(F.col("ts")).alias("ms")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.us == 1710037800123456 and r.ms == 1710037800123
    assert str(r.back) == "2024-03-10 02:30:00.123456"


def test_window_alignment_and_arrival_time(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:02:10' AS event_time, 'a' AS word")
    plain = sorted(str(r.window_start) for r in counts.sliding_counts(df).collect())
    shifted = sorted(str(r.window_start) for r in
                     counts.sliding_counts(df, start_time="30 seconds").collect())
    assert plain[0] == "2023-12-31 23:58:00" and len(plain) == 5
    assert shifted[0] == "2023-12-31 23:57:30" and len(shifted) == 5
    arrived = counts.with_arrival_time(spark.range(3)).select("event_time").distinct().count()
    assert arrived == 1

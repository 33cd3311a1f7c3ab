"""A batch that fails after its sink write is replayed on restart without double counting."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from spindle.streaming import counts, sinks
from spindle.streaming.replay import Replay
from spindle.streaming.run import start, stream_session


class Crash(RuntimeError):
    pass


def _replay(spark, tmp_dir):
    rows = [(0, "a a b"), (1, "a c"), (1, "c c"), (2, "b d")]
    source = spark.createDataFrame(rows, "slice int, value string")
    return Replay(stream_session(spark, 4), source, "slice", f"{tmp_dir}/in")


def _crash_once(write, state):
    """foreachBatch wrapper: the first attempt of batch 1 dies after writing its output."""
    def fn(df, bid):
        write(df, bid)
        if bid == 1 and not state.get("crashed"):
            state["crashed"] = True
            raise Crash("simulated loss after the sink write of batch 1")
    return fn


def _crash_and_restart(replay, run):
    with pytest.raises(StreamingQueryException):
        replay.run([0, 1], run)
    replay.run([2], run)  # restart: batch 1 is taken again from the checkpoint, then slice 2 follows


def test_counter_sink_survives_a_replayed_batch(spark, tmp_dir):
    path = f"{tmp_dir}/counters"
    writer = _crash_once(lambda df, bid: sinks.increment_counts(counts.count_per_batch(df), path, bid), {})
    _crash_and_restart(_replay(spark, tmp_dir), lambda s: start(counts.stream_words(s), f"{tmp_dir}/ck", foreach_batch=writer))
    totals = {r.key: r.total for r in sinks.counter_totals(spark, path).collect()}
    assert totals == {"a": 3, "b": 2, "c": 3, "d": 1}


@pytest.mark.parametrize("full_every", [1, 2, 16])
def test_running_counts_survive_a_replayed_batch(spark, tmp_dir, full_every):
    out, log = f"{tmp_dir}/run", f"{tmp_dir}/totals"
    writer = _crash_once(lambda df, bid: sinks.write_batch_partition(
        counts.running_counts(df, bid, log, full_every=full_every), out, bid), {})
    _crash_and_restart(_replay(spark, tmp_dir), lambda s: start(counts.stream_words(s), f"{tmp_dir}/ck", foreach_batch=writer))
    got = spark.read.parquet(out)
    assert got.filter(F.col("batch_id") == 1).count() == 4  # rewritten once, not appended twice
    totals = sorted(tuple(r) for r in got.select("word", "total").collect())
    assert totals == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2),
                      ("c", 1), ("c", 2), ("c", 3), ("d", 1)]

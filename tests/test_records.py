"""Running totals by record, a caller's state function, and state read back from the state store."""

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from spindle.streaming import counts, records, sinks
from spindle.streaming.replay import Replay
from spindle.streaming.run import start, stream_session

LINES = [(0, 3, "a a b"), (0, 1, "b a"), (1, 2, "c a"), (1, 9, "a c a"), (2, 4, ""), (2, 5, "d b")]


def _by_hand(batches):
    """(id, pos, word) -> total, batch by batch, records in the order of id and place."""
    seen, out = {}, {}
    for batch in batches:
        for i, line in sorted(batch):
            for pos, word in enumerate(line.split(" ")):
                seen[word] = seen.get(word, 0) + 1
                out[(i, pos, word)] = seen[word]
    return out


@pytest.mark.parametrize("parts", [1, 3])
def test_totals_follow_the_records_over_batches_and_a_restart(spark, tmp_dir, parts):
    source = spark.createDataFrame(LINES, "slice int, id long, value string")
    replay, out, path = Replay(stream_session(spark, 4), source, "slice", f"{tmp_dir}/in"), f"{tmp_dir}/out", f"{tmp_dir}/state"

    def begin(stream):
        return start(records.record_words(stream, ("id",)), f"{tmp_dir}/ck", foreach_batch=lambda df, bid:
                     sinks.write_batch_partition(records.record_totals(df, bid, path, ("id", "pos"), parts, full_every=2), out, bid))

    replay.run([0, 1], begin)
    replay.run([2], begin)
    got = {(r.id, r.pos, r.word): r.total for r in spark.read.parquet(out).collect()}
    assert got == _by_hand([[(i, v) for s, i, v in LINES if s == b] for b in range(3)])


def test_a_hot_word_is_numbered_in_parts_and_a_replay_changes_nothing(spark, tmp_dir):
    words = spark.range(0, 5000, 1, 7).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("word"))
    first = records.record_totals(words, 0, f"{tmp_dir}/s", ("id",), parts=6)
    hot = [r.total for r in first.filter("word = 'hot'").orderBy("id").collect()]
    assert hot == list(range(1, len(hot) + 1))
    placed = spark.read.parquet(f"{tmp_dir}/s/placed")
    assert placed.filter("word = 'hot'").select("part").distinct().count() == 6
    again = {}
    for _ in range(2):  # the second time is a replay of batch 1
        second = records.record_totals(words.filter("id < 9"), 1, f"{tmp_dir}/s", ("id",), parts=2)
        again = {r.id: (r.word, r.total) for r in second.collect()}
    assert again[1] == ("hot", len(hot) + 1) and again[8] == ("hot", len(hot) + 6)


def test_an_empty_batch_has_no_totals(spark, tmp_dir):
    words = spark.createDataFrame([], "id long, word string")
    assert records.record_totals(words, 0, f"{tmp_dir}/s", ("id",), parts=2).count() == 0
    after = records.record_totals(spark.createDataFrame([(1, "a")], "id long, word string"), 1, f"{tmp_dir}/s", ("id",), parts=2)
    assert [tuple(r) for r in after.collect()] == [(1, "a", 1)]


def _sum(old, new):
    """The state function of the running sum: what was there plus what came."""
    return F.coalesce(old, F.lit(0)) + new


@F.pandas_udf(LongType())
def _sum_in_batches(old: pd.Series, new: pd.Series) -> pd.Series:
    return old.fillna(0).astype("int64") + new


@pytest.mark.parametrize("update", [_sum, _sum_in_batches])
@pytest.mark.parametrize("full_every", [1, 2, 16])
def test_a_callers_state_function(spark, tmp_dir, update, full_every):
    batches = [["a", "a", "b", None], ["a", "c"], ["c", None, "b", "b"], ["d"]]
    total = {}
    for bid, words in enumerate(batches):
        rows = spark.createDataFrame([(w,) for w in words], "word string")
        for _ in range(2):  # each batch is replayed once
            out = records.update_state(rows, bid, f"{tmp_dir}/s", "word", F.count(F.lit(1)), update, "long", full_every)
        for w in words:
            total[w] = total.get(w, 0) + 1
        assert {r.word: r.state for r in out.collect()} == {w: total[w] for w in words}
    log = spark.read.schema("word string, state long, batch_id long").parquet(f"{tmp_dir}/s")
    assert {r.word: r.state for r in records.latest_states(log).collect()} == total


def test_a_hot_key_is_counted_before_the_shuffle(spark, tmp_dir):
    calls = []

    def update(old, new):
        calls.append(1)  # once per plan, not once per key
        return _sum(old, new)

    words = spark.range(0, 3000, 1, 4).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("word"))
    out = records.update_state(words, 0, f"{tmp_dir}/s", "word", F.count(F.lit(1)), update, "long")
    assert out.filter("word = 'hot'").first().state == 1000 and out.count() == 2001 and len(calls) == 1


def test_state_is_read_after_each_batch_and_after_a_restart(spark, tmp_dir):
    source = spark.createDataFrame([(s, v) for s, _, v in LINES], "slice int, value string")
    ck = f"{tmp_dir}/ck"

    def begin(stream):
        return start(counts.count_snapshot(counts.stream_words(stream)), ck, output_mode="update",
                     foreach_batch=lambda df, bid: sinks.write_batch_partition(df, f"{tmp_dir}/out", bid))

    replay = Replay(stream_session(spark, 4), source, "slice", f"{tmp_dir}/in")
    assert counts.last_batch(spark, ck) == -1
    replay.run([0], begin)
    replay.run([1, 2], begin)
    assert counts.last_batch(spark, ck) == 2
    got = {}
    for r in counts.state_snapshots(spark, ck, [0, 1, 2]).collect():
        got.setdefault(r.batch, {})[r.word] = r.total
    assert got == {0: {"a": 3, "b": 2}, 1: {"a": 6, "b": 2, "c": 2}, 2: {"a": 6, "b": 3, "c": 2, "d": 1, "": 1}}
    assert counts.state_snapshots(spark, ck, []).count() == 0

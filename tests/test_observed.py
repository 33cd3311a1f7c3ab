"""Counters observed in a stream's main pass."""

import pytest
from pyspark.sql import functions as F

from spindle.sources.files import stopword_frame
from spindle.streaming import counts, observed, sinks
from spindle.streaming.replay import Replay
from spindle.streaming.run import start, stream_session


def test_counters_of_every_batch(spark, tmp_dir):
    source = spark.createDataFrame([(0, "the cat"), (0, "and the"), (1, "hat"), (2, "")], "slice int, value string")
    replay = Replay(stream_session(spark, 4), source, "slice", f"{tmp_dir}/in")
    listener, stop = observed.Counters("stop"), stopword_frame(spark, ["the", "and", "the"])

    def begin(stream):
        flagged = observed.counted(observed.flagged_tokens(counts.stream_words(stream), stop), "stop", *observed.stopword_counters())
        return observed.listening(stream, listener, lambda: start(
            flagged, f"{tmp_dir}/ck", foreach_batch=lambda df, bid: sinks.write_batch_partition(
                counts.count_per_batch(df.filter("not is_stop")), f"{tmp_dir}/out", bid)))

    replay.run(replay.slices, begin)
    assert {b: (r["n_tokens"], r["n_stop"]) for b, r in listener.wait().items()} == {0: (4, 3), 1: (1, 0), 2: (1, 0)}
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/out").select("batch_id", "word", "n").collect()) == [
        (0, "cat", 1), (1, "hat", 1), (2, "", 1)]


def test_a_query_that_never_ends_is_reported():
    with pytest.raises(TimeoutError):
        observed.Counters("none").wait(0.05)


def test_missing_parts_are_optional_and_broken_ones_are_not(tmp_path, monkeypatch):
    import __spark_entry__ as entry
    (tmp_path / "half_there" / "__pycache__").mkdir(parents=True)  # a folder without its modules
    (tmp_path / "broken_part.py").write_text("import no_such_module_at_all\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    assert entry._optional("half_there.queries") is None and entry._optional("not_there.queries") is None
    with pytest.raises(ModuleNotFoundError):
        entry._optional("broken_part")

"""SNK-1 text pairs and the batch-keyed table sinks."""

import pytest
from pyspark.errors import PySparkException

from spindle.operators import stats
from spindle.sinks import read_pairs_text, save_pairs_text
from spindle.sources import key_values
from spindle.streaming import sinks


def test_save_pairs_text(spark, tmp_dir):
    kv = key_values(spark, [("coffee", 1), ("coffee", 3), ("panda", 4), ("coffee", 5),
                            ("street", 2), ("panda", 5)])
    path = f"{tmp_dir}/out"
    save_pairs_text(stats.avg_by_key(kv), path, "key", "avg_value")
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ["(coffee,3.0)", "(panda,4.5)", "(street,2.0)"]
    back = {r.key: r.value for r in read_pairs_text(spark, path).collect()}
    assert back == {"coffee": "3.0", "panda": "4.5", "street": "2.0"}
    with pytest.raises(PySparkException):
        save_pairs_text(stats.avg_by_key(kv), path, "key", "avg_value")


def _totals(spark, path):
    return {r.key: r.total for r in sinks.counter_totals(spark, path).collect()}


def test_counter_increments_are_replay_safe(spark, tmp_dir):
    path = f"{tmp_dir}/counters"
    b0 = spark.createDataFrame([("a", 2), ("b", 1)], "word string, n long")
    b1 = spark.createDataFrame([("a", 1), ("c", 1)], "word string, n long")
    sinks.increment_counts(b0, path, 0)
    sinks.increment_counts(b1, path, 1)
    sinks.increment_counts(b1, path, 1)  # replay of batch 1
    assert _totals(spark, path) == {"a": 3, "b": 1, "c": 1}


def test_two_programs_share_a_counter_table(spark, tmp_dir):
    path = f"{tmp_dir}/counters"
    rows = lambda *r: spark.createDataFrame(list(r), "word string, n long")
    sinks.increment_counts(rows(("a", 2), ("b", 1)), path, 0, writer="first")
    sinks.increment_counts(rows(("a", 1), ("c", 1)), path, 1, writer="first")
    sinks.increment_counts(rows(("a", 2), ("b", 1)), path, 0, writer="second")  # its own checkpoint
    assert _totals(spark, path) == {"a": 5, "b": 2, "c": 1}


def test_replay_after_compaction_does_not_count_twice(spark, tmp_dir):
    path = f"{tmp_dir}/counters"
    b1 = spark.createDataFrame([("a", 2)], "word string, n long")
    sinks.increment_counts(b1, path, 0)
    sinks.compact_counters(spark, path)
    assert _totals(spark, path) == {"a": 2}
    sinks.increment_counts(b1, path, 0)  # replay of a folded batch
    assert _totals(spark, path) == {"a": 2}
    sinks.increment_counts(b1, path, 1)
    sinks.increment_counts(b1, path, 0, writer="other")
    sinks.compact_counters(spark, path)
    sinks.increment_counts(b1, path, 1)
    assert _totals(spark, path) == {"a": 6}


def test_unfinished_snapshot_is_ignored(spark, tmp_dir):
    path = f"{tmp_dir}/counters"
    sinks.increment_counts(spark.createDataFrame([("a", 2)], "word string, n long"), path, 0)
    spark.createDataFrame([("a", 99)], "key string, n long").write.parquet(f"{path}/snapshots/v1/totals")
    assert _totals(spark, path) == {"a": 2}
    sinks.compact_counters(spark, path)
    assert _totals(spark, path) == {"a": 2}


def test_timed_counts_overwrite_per_batch(spark, tmp_dir):
    path = f"{tmp_dir}/timed"
    df = spark.createDataFrame([(1000, "a", 2)], "time_ms long, word string, n long")
    sinks.append_timed_counts(df, path, 0)
    sinks.append_timed_counts(df, path, 0)
    assert [tuple(r) for r in sinks.timed_cells(spark, path).collect()] == [(1000, "a", 2)]


def test_last_write_of_a_timed_cell_wins(spark, tmp_dir):
    path = f"{tmp_dir}/timed"
    schema = "time_ms long, word string, n long"
    sinks.append_timed_counts(spark.createDataFrame([(1000, "a", 2), (1000, "b", 5)], schema), path, 0)
    sinks.append_timed_counts(spark.createDataFrame([(1000, "a", 7)], schema), path, 1)
    assert sorted(tuple(r) for r in sinks.timed_cells(spark, path).collect()) == [(1000, "a", 7), (1000, "b", 5)]


ODD_KEYS = ["a\u0085b", "a\u2028b", "a\u2029b", "line\nbreak", "carriage\rreturn", "both\r\n", "back\\slash", "\\n",
            "\\\\n\n", "\\N", "", None, "a,b", "(x)"]


def test_odd_keys_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(ODD_KEYS)], "k string, v long")
    save_pairs_text(df, f"{tmp_dir}/pairs", "k", "v")
    back = {int(r.value): r.key for r in read_pairs_text(spark, f"{tmp_dir}/pairs").collect()}
    assert back == dict(enumerate(ODD_KEYS))
    sinks.save_batch_dir(df, f"{tmp_dir}/out", 0)
    back = {r.v: r.k for r in sinks.read_batch_dirs(spark, f"{tmp_dir}/out", "k string, v long").collect()}
    assert back == dict(enumerate(ODD_KEYS))


def test_unreadable_lines_fail(spark, tmp_dir):
    spark.createDataFrame([("no pair",)], "value string").write.text(f"{tmp_dir}/pairs")
    with pytest.raises(PySparkException, match="unreadable line"):
        read_pairs_text(spark, f"{tmp_dir}/pairs").collect()
    spark.createDataFrame([("only one field",)], "value string").write.text(f"{tmp_dir}/out-0")
    with pytest.raises(PySparkException, match="unreadable line"):
        sinks.read_batch_dirs(spark, f"{tmp_dir}/out", "word string, n long").collect()


def test_batch_time_is_fixed_within_a_batch(spark, tmp_dir):
    from pyspark.sql import functions as F

    from spindle.streaming.run import batch_time_ms
    df = spark.range(0, 1000, 1, 8).select(batch_time_ms().alias("t"))
    path = f"{tmp_dir}/timed"
    sinks.append_timed_counts(df.select("t", F.lit("w").alias("word"), F.lit(1).alias("n")),
                              path, 3, time_ms_col="t")
    assert spark.read.parquet(path).select("time_ms").distinct().count() == 1


def test_batch_dirs_round_trip_tabs_and_quotes(spark, tmp_dir):
    prefix = f"{tmp_dir}/out"
    df = spark.createDataFrame([(1, "a\tb", 2), (1, 'say "hi"', 1), (1, "", 3)],
                               "slice int, word string, n long")
    sinks.save_batch_dir(df, prefix, 0)
    assert sorted(r.value for r in spark.read.text(f"{prefix}-0").collect()) == \
        ["1\t\t3", "1\ta\tb\t2", '1\tsay "hi"\t1']
    back = sorted(tuple(r) for r in
                  sinks.read_batch_dirs(spark, prefix, "slice int, word string, n long").collect())
    assert back == [(1, "", 3), (1, "a\tb", 2), (1, 'say "hi"', 1)]

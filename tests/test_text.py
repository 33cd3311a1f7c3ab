"""Word counts, stop words, top-k and their physical plans."""

from pyspark.sql import functions as F

from spindle.operators import text
from spindle.sources import stopword_frame


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_word_counts_and_top(spark):
    words = text.split_words(_lines(spark, ["a b a", "c a b", ""]))
    counts = {r.word: r.n for r in text.word_counts(words).collect()}
    assert counts == {"a": 3, "b": 2, "c": 1, "": 1}
    top = text.top_words(text.word_counts(words), 2)
    assert [(r.word, r.n) for r in top.collect()] == [("a", 3), ("b", 2)]
    assert "TakeOrderedAndProject" in _plan(top)
    assert text.distinct_words(words).first().n_distinct == 4


def test_top_words_tie_break(spark):
    words = text.split_words(_lines(spark, ["z y x", "x y"]))
    top = text.top_words(text.word_counts(words), 3).collect()
    assert [(r.word, r.n) for r in top] == [("x", 2), ("y", 2), ("z", 1)]


def test_drop_stopwords_broadcast_anti_join(spark):
    words = text.clean_words(_lines(spark, ["The cat and the hat.", "A cat!"]))
    stop = stopword_frame(spark, ["the", "a", "and"])
    kept = text.drop_stopwords(words, stop)
    assert sorted(r.word for r in kept.collect()) == ["A", "The", "cat", "cat", "hat"]  # case kept
    plan = _plan(kept)
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_stopword_totals_with_duplicate_stop_list(spark):
    words = text.clean_words(_lines(spark, ["the cat and the hat"]))
    stop = stopword_frame(spark, ["the", "the", "and"])
    r = text.stopword_totals(words, stop).first()
    assert (r.n_tokens, r.n_stop) == (5, 3)


def test_stopword_report_observation(spark):
    words = text.clean_words(_lines(spark, ["the cat and the hat", "cat"]))
    top, obs = text.stopword_report(words, stopword_frame(spark, ["the", "and"]), 1)
    assert [(r.word, r.n) for r in top.collect()] == [("cat", 2)]
    assert obs.get == {"n_tokens": 6, "n_stop": 3}


def test_large_stop_list_is_not_broadcast(spark):
    from spindle.operators.joins import checked_broadcast
    big = spark.range(100).select(F.col("id").cast("string").alias("word"))
    words = spark.createDataFrame([("1",), ("x",)], "word string")
    joined = words.join(checked_broadcast(big, "word", max_rows=10), "word", "left_anti")
    assert sorted(r.word for r in joined.collect()) == ["x"]
    assert checked_broadcast(big, "word", max_rows=10) is big  # no hint
    joined_small = words.join(checked_broadcast(big, "word", max_rows=1000), "word", "left_anti")
    assert "BroadcastHashJoin" in _plan(joined_small)


def test_count_and_top_one_pass(spark):
    words = text.split_words(_lines(spark, ["a b a", "c a b d"]))
    top, obs = text.count_and_top(words, 2)
    assert [(r.word, r.n) for r in top.collect()] == [("a", 3), ("b", 2)]
    assert obs.get == {"n_distinct": 4}


def test_broadcast_guard_byte_limit(spark):
    from spindle.operators.joins import checked_broadcast
    wide = spark.createDataFrame([("x" * 1000,), ("y" * 1000,)], "word string")
    # 2000 key bytes: over a 1500-byte limit the side comes back without a hint
    assert checked_broadcast(wide, "word", max_bytes=1500) is wide
    assert checked_broadcast(wide, "word", max_bytes=4000) is not wide


def test_broadcast_guard_counts_every_column(spark):
    from spindle.operators.joins import checked_broadcast
    rows = spark.createDataFrame([("a", "x" * 1000, [1, 2], 7, None), ("b", None, None, None, True)],
                                 "word string, note string, ids array<long>, n long, flag boolean")
    assert checked_broadcast(rows, "word", max_bytes=1000) is rows
    assert checked_broadcast(rows.select("word"), "word", max_bytes=1000).columns == ["word"]
    assert checked_broadcast(rows, "word", max_bytes=4000) is not rows
    assert checked_broadcast(rows.limit(0), "word", max_bytes=0) is not None

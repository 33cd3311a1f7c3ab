"""Physical-plan properties the scale design relies on."""

import contextlib
import io

from pyspark.sql import functions as F

from spindle.operators import stats, text
from spindle.operators.layout import spread
from spindle.plans import queries

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_word_is_pre_aggregated_before_the_shuffle(spark):
    # one word holds a third of all tokens
    n = 30_000
    lines = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.col("id")))
        .alias("value"))
    counts = text.word_counts(text.split_words(lines))
    got = {r.word: r.n for r in counts.filter("word = 'hot' or word = 'w1'").collect()}
    assert got == {"hot": n // 3, "w1": 1}
    plan = _formatted(counts)
    assert "partial_count" in plan and plan.index("partial_count") < plan.rindex("Exchange")


def test_keyed_stats_are_single_pass_partial_aggregates(spark):
    lines = spark.createDataFrame([("1,2,3,4",), ("1,5,6,7",)], "value string")
    plan = _formatted(stats.xyz_by_id(stats.parse_longs(lines)))
    for f in ("partial_max", "partial_min", "partial_sum", "partial_count"):
        assert f in plan


def test_scans_read_only_needed_columns(spark):
    for name, cols in [("word_counts", "struct<text:string>"),
                       ("global_stats", "struct<o_orderkey:bigint>"),
                       ("status_counts", "struct<user_id:bigint,event_type:string>")]:
        plan = _formatted(queries()[name](spark, SF))
        assert f"ReadSchema: {cols}" in plan, name


def test_top_words_avoids_full_sort(spark):
    plan = _plan(queries()["top_words"](spark, SF))
    assert "TakeOrderedAndProject" in plan and "Sort [" not in plan


def test_spread_only_when_asked(spark):
    df = spark.range(0, 1000, 1, 1)
    assert spread(df, None) is df
    assert spread(df, 4).rdd.getNumPartitions() == 4


def test_stop_words_are_looked_up_after_counting(spark):
    """Without a broadcast, the join moves partial counts, not tokens."""
    from spindle.operators.joins import checked_broadcast
    lines = spark.createDataFrame([("the cat the hat",)], "value string")
    stop = spark.range(100).select(F.col("id").cast("string").alias("word"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert checked_broadcast(stop, "word", max_rows=10) is stop
        counted = text.word_counts(text.clean_words(lines))
        plan = _plan(counted.join(checked_broadcast(stop, "word", max_rows=10), "word", "left_anti"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan
    assert plan.index("SortMergeJoin") < plan.index("Exchange") < plan.index("partial_count")


def test_sorted_counts_come_in_exact_order(spark):
    got = [(r.word, r.n) for r in queries()["sorted_counts"](spark, SF).collect()]
    assert got == sorted(got, key=lambda x: (-x[1], x[0].encode()))
    assert len(got) > 1000


def test_broadcast_probe_is_one_row_per_task(spark):
    """The guard measures with an aggregate; no limit gathers rows in one task."""
    import inspect

    from spindle.operators import joins
    assert "limit(" not in inspect.getsource(joins.checked_broadcast)

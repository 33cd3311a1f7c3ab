"""Word statistics over line tables (PRJ-1..4, FLT-2/3, JON-1/2, AGG-5/9/11, SRT-1, TOP-1).

Inputs are DataFrames with one text line per row in column ``value``.  Results are
lazy DataFrames; only the stop-word operators run a small job while the plan is built,
which measures the stop list.  Aggregation is hash-partial on the map side before the
single shuffle by word, so a word holding a third of all tokens costs one
pre-aggregated row per map task, not a hot reducer; stop words are looked up once per
distinct word, after counting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from spindle.functions.tokens import clean_tokens, space_tokens
from spindle.operators.joins import checked_broadcast


def split_words(lines: DataFrame, col: str = "value") -> DataFrame:
    """PRJ-1: one row per space-separated token, column ``word``."""
    return lines.select(F.explode(space_tokens(F.col(col))).alias("word"))


def clean_words(lines: DataFrame, col: str = "value") -> DataFrame:
    """PRJ-2 + FLT-3: cleaned, non-blank tokens, column ``word``."""
    return lines.select(F.explode(clean_tokens(F.col(col))).alias("word"))


def word_counts(words: DataFrame) -> DataFrame:
    """AGG-5: ``(word, n)`` for every distinct word."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def distinct_words(words: DataFrame) -> DataFrame:
    """AGG-11: number of distinct words, one row ``n_distinct``.

    Counted as the size of the grouped result, so it reuses the partial/final
    aggregation of ``word_counts`` instead of a second distinct aggregate.
    """
    return word_counts(words).agg(F.count(F.lit(1)).alias("n_distinct"))


def sorted_counts(counts: DataFrame) -> DataFrame:
    """SRT-1: total order by count descending, ties by word (range-partitioned sort)."""
    return counts.orderBy(F.desc("n"), F.asc("word"))


def top_words(counts: DataFrame, k: int) -> DataFrame:
    """TOP-1: the ``k`` most frequent words (``TakeOrderedAndProject``, no full sort)."""
    return counts.orderBy(F.desc("n"), F.asc("word")).limit(k)


def count_and_top(words: DataFrame, k: int) -> tuple[DataFrame, Observation]:
    """Distinct-word count and top-k words from one pass (AGG-11 + TOP-1, CCH-1).

    The grouped counts flow through an ``observe`` node on their way into the
    top-k, so the number of distinct words is measured by the same job that ranks
    them; nothing has to be cached for a second action.  ``obs.get`` holds
    ``n_distinct`` once the returned DataFrame has been evaluated.
    """
    obs = Observation("distinct_words")
    counted = word_counts(words).observe(obs, F.count(F.lit(1)).alias("n_distinct"))
    return top_words(counted, k), obs


def drop_stopwords(words: DataFrame, stopwords: DataFrame) -> DataFrame:
    """JON-1 / FLT-2: rows whose ``word`` is not in the stop list, as a left-anti join.

    Pass counts (one row per distinct word) rather than raw words: the join then moves
    the vocabulary, not the tokens.  The stop list is broadcast when its size is proven
    small, else shuffled.
    """
    stop = checked_broadcast(stopwords.select("word"), "word")
    return words.join(stop, on="word", how="left_anti")


def _flag_stopwords(words: DataFrame, stopwords: DataFrame) -> DataFrame:
    marks = stopwords.select("word").distinct().withColumn("is_stop", F.lit(True))
    return words.join(checked_broadcast(marks, "word"), on="word", how="left")


def stopword_totals(words: DataFrame, stopwords: DataFrame) -> DataFrame:
    """JON-2 + AGG-9: ``n_tokens`` (all tokens) and ``n_stop`` (tokens in the stop list).

    Words are counted first; a mark join (left outer against the de-duplicated list) then
    flags each distinct word, and one global aggregate sums its counts into both counters.
    """
    return _flag_stopwords(word_counts(words), stopwords).agg(*_stopword_counters())


def _stopword_counters() -> list[Column]:
    return [F.coalesce(F.sum("n"), F.lit(0)).alias("n_tokens"),
            F.coalesce(F.sum(F.when(F.col("is_stop"), F.col("n"))), F.lit(0)).alias("n_stop")]


def stopword_report(words: DataFrame, stopwords: DataFrame, k: int) -> tuple[DataFrame, Observation]:
    """Top-k non-stop words plus token counters observed in the same pass.

    Returns the top-k DataFrame and an ``Observation`` whose ``get`` holds
    ``n_tokens`` and ``n_stop`` once the DataFrame has been evaluated.
    """
    obs = Observation("stopword_totals")
    flagged = _flag_stopwords(word_counts(words), stopwords).observe(obs, *_stopword_counters())
    return top_words(flagged.filter(F.col("is_stop").isNull()).select("word", "n"), k), obs

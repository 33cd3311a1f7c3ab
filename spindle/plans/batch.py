"""Batch catalogue queries: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.operators import layout, stats, text
from spindle.plans.inputs import (catalog_stopwords, prose_lines, status_log_lines,
                                  supplier_csv_lines)
from spindle.session import scratch_path
from spindle.sinks.batch import read_pairs_text, save_pairs_text
from spindle.sources.tables import load_table


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_counts(text.split_words(prose_lines(spark, sf_dir)))


def distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.distinct_words(text.split_words(prose_lines(spark, sf_dir)))


def sorted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.sorted_counts(word_counts(spark, sf_dir))


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.top_words(word_counts(spark, sf_dir), 5)


def clean_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = text.word_counts(text.clean_words(prose_lines(spark, sf_dir)))
    return text.top_words(text.drop_stopwords(counts, catalog_stopwords(spark)), 10)


def stopword_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text.clean_words(prose_lines(spark, sf_dir))
    return text.stopword_totals(words, catalog_stopwords(spark))


def count_and_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CCH-1: the 5 most frequent words and the number of distinct words, from one job over the text."""
    top, seen = text.count_and_top(text.split_words(prose_lines(spark, sf_dir)), 5)
    path = scratch_path(spark, "count-and-top")
    top.write.parquet(path)
    return spark.read.schema(top.schema).parquet(path).withColumn("n_distinct", F.lit(seen.get["n_distinct"]).cast("long"))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.status_counts(stats.parse_status(status_log_lines(spark, sf_dir)))


def xyz_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.xyz_by_id(stats.parse_longs(supplier_csv_lines(spark, sf_dir)))


def avg_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_table(spark, sf_dir, "orders", "o_orderpriority", "o_custkey")
    return stats.avg_by_key(orders, "o_orderpriority", "o_custkey")


def _order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "orders", "o_orderkey").withColumnRenamed("o_orderkey", "id")


def global_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.global_stats(_order_keys(spark, sf_dir), "id")


def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.head(_order_keys(spark, sf_dir), 5, "id")


def even_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.head(stats.filter_even(_order_keys(spark, sf_dir), "id"), 5, "id")


def _line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "lineitem", "l_orderkey").withColumnRenamed("l_orderkey", "id")


def union_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.union_all(_order_keys(spark, sf_dir), _line_keys(spark, sf_dir))


# Partition numbers of the layout queries, the same at every size.
LAYOUT_LEFT, LAYOUT_RIGHT, LAYOUT_MERGED, LAYOUT_SPREAD = 48, 32, 48, 160
KEY_PARTITIONS = 128
LISTED_PLACES = 96


def layout_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of two layouts, coalesced without a shuffle, then reshuffled: the sizes, from one pass."""
    left = layout.repartition_to(_order_keys(spark, sf_dir), LAYOUT_LEFT)
    right = layout.repartition_to(_line_keys(spark, sf_dir), LAYOUT_RIGHT)
    return layout.layout_flow([(left, LAYOUT_LEFT), (right, LAYOUT_RIGHT)], LAYOUT_MERGED, LAYOUT_SPREAD).drop("n_held")


def _placed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys, each in partition ``key mod KEY_PARTITIONS``."""
    place = F.pmod("id", F.lit(KEY_PARTITIONS)).cast("int")
    return _order_keys(spark, sf_dir).repartitionById(KEY_PARTITIONS, place)


def partition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRT-4: rows and key range of every partition."""
    return layout.partition_report(_placed_keys(spark, sf_dir), "id", KEY_PARTITIONS)


def partition_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRT-3: the keys that every partition holds."""
    return layout.partition_contents(_placed_keys(spark, sf_dir), "id")


def partition_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRT-3: all 128 partitions with their keys, of which every fourth is empty by its rule."""
    place = F.pmod("id", F.lit(LISTED_PLACES)).cast("int")
    place = place + F.floor(place / 3).cast("int")  # 0, 1, 2, 4, 5, 6, 8, ...
    placed = _order_keys(spark, sf_dir).repartitionById(KEY_PARTITIONS, place)
    return layout.partition_listing(placed.withColumn("id", F.col("id").cast("string")), "id", KEY_PARTITIONS)


def clean_top_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-9 in the main pass: the 10 most frequent clean words, with the token counters observed on the way."""
    top, seen = text.stopword_report(text.clean_words(prose_lines(spark, sf_dir)), catalog_stopwords(spark), 10)
    path = scratch_path(spark, "clean-top-report")
    top.write.parquet(path)
    counters = seen.get
    return spark.read.schema(top.schema).parquet(path).withColumns(
        {name: F.lit(counters[name]).cast("long") for name in ("n_tokens", "n_stop")})


def saved_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """avg_by_key saved as ``(key,value)`` text lines, then read back."""
    path = scratch_path(spark, "saved-pairs")
    save_pairs_text(avg_by_key(spark, sf_dir), path, "key", "avg_value")
    return read_pairs_text(spark, path).select(
        "key", F.col("value").cast("double").alias("avg_value"))


BATCH_QUERIES = {
    "word_counts": word_counts,
    "distinct_words": distinct_words,
    "sorted_counts": sorted_counts,
    "top_words": top_words,
    "count_and_top": count_and_top,
    "clean_top_words": clean_top_words,
    "stopword_totals": stopword_totals,
    "status_counts": status_counts,
    "xyz_by_id": xyz_by_id,
    "avg_by_key": avg_by_key,
    "global_stats": global_stats,
    "head_rows": head_rows,
    "even_head": even_head,
    "union_keys": union_keys,
    "layout_sizes": layout_sizes,
    "partition_rows": partition_rows,
    "partition_contents": partition_contents,
    "partition_listing": partition_listing,
    "clean_top_report": clean_top_report,
    "saved_pairs": saved_pairs,
}

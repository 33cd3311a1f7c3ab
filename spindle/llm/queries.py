"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import (ann, bagminhash, centroids, chat, decontaminate, hosts, lexical, linededup, packing, pii,
                         quality, sharding, substrings)
from spindle.llm.oracle import ORACLE_SQL
from spindle.sources.tables import load_table

__all__ = ["ORACLE_SQL", "QUERIES"]

QueryFn = Callable[[SparkSession, str], DataFrame]

PROBE_TEXT = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, and of conversation -1, read back from the output."""
    turns = load_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE_TEXT), (-1, 1, "assistant", PROBE_TEXT)], turns.schema)
    return chat.conversation_digests(chat.format_conversations(turns.unionByName(probe)))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line numbers that every document loses to earlier documents."""
    return linededup.document_losses(load_table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 50."""
    table = load_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(table, F.col("vec_id") % 50 == 0, k=5)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin."""
    return packing.pack_documents(load_table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.document_spans(load_table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that match, with the best window's similarity."""
    return decontaminate.contaminated(load_table(spark, sf_dir, "documents", "doc_id", "text"),
                                      load_table(spark, sf_dir, "benchmark", "item_id", "text"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document, 24 shards."""
    return sharding.document_shards(load_table(spark, sf_dir, "documents", "doc_id", "text"), n_shards=24)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 400-byte strings."""
    return substrings.remove_repeats(load_table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return quality.score_documents(load_table(spark, sf_dir, "documents", "doc_id", "text"),
                                   load_table(spark, sf_dir, "labels", "doc_id", "quality"))


def op10_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document: ``class_id`` is the least doc_id of its group of links,
    ``copies_id`` the least doc_id with the same shingle multiset."""
    grouped = bagminhash.near_duplicates(load_table(spark, sf_dir, "documents", "doc_id", "text"))
    return grouped.select("doc_id", F.col("group_doc").alias("class_id"), F.col("class_doc").alias("copies_id"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical.rank_documents(load_table(spark, sf_dir, "documents", "doc_id", "text"),
                                  load_table(spark, sf_dir, "benchmark", "item_id", "text"))


PAGE_RULES = [hosts.Rule("org", "/", False), hosts.Rule("example.org", "/es/", True),
              hosts.Rule("example.org", "/en/1", True), hosts.Rule("com", "/fr/", False), hosts.Rule("com", "/de/", True)]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page, by rule or by the host's reputation."""
    return hosts.judge_pages(load_table(spark, sf_dir, "pages", "page_id", "url"), PAGE_RULES)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector of 64 components after 10 rounds from 8 centroids."""
    return centroids.cluster_vectors(load_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES: dict[str, QueryFn] = {
    "op1_chat_format": op1_chat_format,
    "op2_line_dedup": op2_line_dedup,
    "op3_multi_index_search": op3_multi_index_search,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_contextual_pii": op5_contextual_pii,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_bag_minhash": op10_bag_minhash,
    "op11_lexical_search": op11_lexical_search,
    "op12_url_filter": op12_url_filter,
    "op13_centroid_clustering": op13_centroid_clustering,
}

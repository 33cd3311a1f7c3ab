"""A corpus pipeline: quality, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it
kept; every stage but the last returns the columns of ``documents``.  ``run`` writes each
stage's rows as Parquet in the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spindle.llm import bagminhash, decontaminate, linededup, packing, quality
from spindle.llm.common import keep
from spindle.sources.tables import load_table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted_documents(docs, load_table(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that an earlier document has; those left empty by it go."""
    return linededup.drop_lost_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every near-duplicate group."""
    return bagminhash.first_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(docs, load_table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: No stage but the first-of-group choices can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    rows = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = keep(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)

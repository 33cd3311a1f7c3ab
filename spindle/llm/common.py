"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.session import scratch_path


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: later jobs read the files, so nothing upstream is computed
    again when an executor is lost and values such as partition numbers stay fixed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def body(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def order_key(*columns: str) -> list[Column]:
    """Ascending order, nulls first."""
    return [F.col(c).asc_nulls_first() for c in columns]


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)

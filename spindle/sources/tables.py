"""Column-pruned loads of the parquet tables in a scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet`` keeping only ``columns``.

    Selecting up front keeps the parquet ``ReadSchema`` narrow even before the
    optimizer prunes, and documents which columns each query touches.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df

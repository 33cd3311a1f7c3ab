"""Small in-memory sources (SRC-2, SRC-3).

These build DataFrames from driver-side literals, as the practice programs do; they
are for fixtures and examples.  Production inputs come from files or tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def int_range(spark: SparkSession, start: int, end_inclusive: int, partitions: int) -> DataFrame:
    """Integers ``start..end_inclusive`` in ``partitions`` slices, column ``id`` (bigint)."""
    return spark.range(start, end_inclusive + 1, 1, partitions)


def int_list(spark: SparkSession, values: list[int], partitions: int) -> DataFrame:
    """A literal list of integers split into ``partitions`` contiguous slices, column ``id``.

    Slicing matches ``parallelize``: slice i holds values[i*n//p:(i+1)*n//p].
    """
    n = len(values)
    rows = []
    for p in range(partitions):
        for v in values[p * n // partitions:(p + 1) * n // partitions]:
            rows.append((p, v))
    schema = T.StructType([T.StructField("slice", T.IntegerType(), False),
                           T.StructField("id", T.LongType(), False)])
    df = spark.createDataFrame(rows, schema)
    # slice i goes to partition i, keeping the contiguous layout of the literal list
    return (df.repartitionById(partitions, "slice")
              .sortWithinPartitions("slice", "id")
              .select("id"))


def key_values(spark: SparkSession, pairs: list[tuple[str, int]]) -> DataFrame:
    """Key/value literal rows, columns ``k`` (string) and ``v`` (bigint)."""
    schema = T.StructType([T.StructField("k", T.StringType(), False),
                           T.StructField("v", T.LongType(), False)])
    return spark.createDataFrame([(k, int(v)) for k, v in pairs], schema)

"""Union and partition layout (SET-1, PRT-1..4).

Partitions are inspected with ``spark_partition_id()``: an aggregate over it is partial
inside each task, so one small row per partition is shuffled, and empty partitions are
added from the known partition numbers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """SET-1: bag union by column name; partition counts add up."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def coalesce_to(df: DataFrame, n: int) -> DataFrame:
    """PRT-1: fewer partitions by merging neighbours, no shuffle."""
    return df.coalesce(n)


def repartition_to(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """PRT-2: exactly ``n`` partitions through a shuffle (round-robin, or hashed on ``cols``)."""
    return df.repartition(n, *cols)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Round-robin ``df`` over ``partitions``; None leaves it as it is.

    For CPU-heavy row work after a scan of a few large row groups, where the caller
    knows that the scan has fewer splits than the cluster has cores.
    """
    return df.repartition(partitions) if partitions else df


def num_partitions(df: DataFrame) -> int:
    """PRT-4: partition count of the planned DataFrame.

    Plan metadata for scans and narrow plans; with adaptive execution a plan that
    contains shuffles is finalised first (its shuffle stages run), so pass the known
    number to the reports below where there is one.
    """
    return df.rdd.getNumPartitions()


def _all_partitions(df: DataFrame, found: DataFrame, partitions: int | None) -> DataFrame:
    n = num_partitions(df) if partitions is None else partitions
    known = df.sparkSession.range(n).select(F.col("id").cast("int").alias("partition"))
    return known.join(found, "partition", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def partition_counts(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(partition, n_rows)`` for every partition of ``df``, empty ones included."""
    found = (df.select(F.spark_partition_id().alias("partition"))
             .groupBy("partition").agg(F.count(F.lit(1)).alias("n_rows")))
    return _all_partitions(df, found, partitions).select("partition", "n_rows")


def partition_report(df: DataFrame, col: str = "id", partitions: int | None = None) -> DataFrame:
    """``(partition, n_rows, min_value, max_value)`` for every partition, NULL bounds for empty ones."""
    found = (df.select(F.spark_partition_id().alias("partition"), F.col(col))
             .groupBy("partition").agg(F.count(F.lit(1)).alias("n_rows"), F.min(col).alias("min_value"),
                                       F.max(col).alias("max_value")))
    return _all_partitions(df, found, partitions).select("partition", "n_rows", "min_value", "max_value")


def partition_contents(df: DataFrame, col: str = "id") -> DataFrame:
    """PRT-3: the rows of every partition as ``(partition, value)``, without gathering them.

    Empty partitions have no rows here; ``partition_listing`` and ``partition_counts`` list them.
    """
    return df.select(F.spark_partition_id().alias("partition"), F.col(col).alias("value"))


def partition_listing(df: DataFrame, col: str = "id", partitions: int | None = None) -> DataFrame:
    """PRT-3: the rows of every partition, and one row with a NULL value and ``empty`` for each empty partition.

    Contents stay where they are: the empty partitions come from a count per partition (one
    row each) and are added by a union.
    """
    held = partition_contents(df, col).withColumn("empty", F.lit(False))
    none = (partition_counts(df, partitions).filter("n_rows = 0")
            .select("partition", F.lit(None).cast(df.schema[col].dataType).alias("value"), F.lit(True).alias("empty")))
    return held.unionByName(none)


def layout_sizes(stages: list[tuple[str, DataFrame, int]]) -> DataFrame:
    """``(stage, n_partitions, n_rows)`` for each stage (name, frame, its partition number) of a layout.

    All stages are summarised in one job (their shared shuffles are planned once and
    reused).
    """
    rows = [partition_counts(df, n).agg(F.count(F.lit(1)).alias("n_partitions"), F.sum("n_rows").alias("n_rows"))
            .select(F.lit(name).alias("stage"), "n_partitions", "n_rows")
            for name, df, n in stages]
    return union_all(*rows)


def layout_flow(frames: list[tuple[DataFrame, int]], merged: int, spread_over: int) -> DataFrame:
    """Union (SET-1), coalesce (PRT-1), repartition (PRT-2) and their sizes (PRT-4), in one pass over the rows.

    ``frames`` are the united frames with their partition numbers.  Each row notes its
    partition number as it passes through a stage, so one aggregate sees all three stages:
    ``(stage, n_partitions, n_held, n_rows)``, ``n_held`` being the partitions with rows.
    Rows are moved once, by the repartition.
    """
    at = F.spark_partition_id
    united = union_all(*(df.select() for df, _ in frames)).select(at().alias("united"))
    narrowed = coalesce_to(united, merged).select("united", at().alias("merged"))
    placed = repartition_to(narrowed, spread_over).select("united", "merged", at().alias("spread"))
    # partial inside each task: a count and three sets of partition numbers
    totals = placed.agg(F.count(F.lit(1)).alias("n_rows"),
                        *(F.size(F.collect_set(c)).cast("long").alias(c) for c in ("united", "merged", "spread")))
    sizes = [("union", sum(n for _, n in frames), "united"), ("coalesce", min(merged, sum(n for _, n in frames)), "merged"),
             ("repartition", spread_over, "spread")]
    stages = F.array(*(F.struct(F.lit(name).alias("stage"), F.lit(n).cast("long").alias("n_partitions"),
                                F.col(c).alias("n_held")) for name, n, c in sizes))
    return totals.select(F.explode(stages).alias("s"), "n_rows").select("s.*", "n_rows")

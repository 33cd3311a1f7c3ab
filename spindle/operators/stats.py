"""Global and per-key statistics (FLT-1, AGG-1..4, AGG-6..8, LIM-1, PRJ-5/6).

All aggregates are single-pass and algebraic (sum / count / min / max), so Spark
runs them as partial aggregates on the map side; a hot key only sends one partial
row per map task across the shuffle.  Averages are the exact integer sum divided
once by the count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.functions.parse import parse_long_fields, parse_status_code


def exact_avg(col: str | Column) -> Column:
    """Average of an integer column: exact bigint sum, one division."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c) / F.count(c)


def filter_even(df: DataFrame, col: str = "id") -> DataFrame:
    """FLT-1: rows whose integer ``col`` is even."""
    return df.filter(F.col(col) % 2 == 0)


def global_stats(df: DataFrame, col: str = "id") -> DataFrame:
    """AGG-1..4: ``total`` (sum), ``n`` (rows), ``mean`` and ``n_even`` in one pass."""
    c = F.col(col)
    return df.agg(
        F.sum(c).alias("total"),
        F.count(F.lit(1)).alias("n"),
        (F.sum(c) / F.count(F.lit(1))).alias("mean"),
        F.count_if(c % 2 == 0).alias("n_even"),
    )


def head(df: DataFrame, n: int, order_col: str = "id") -> DataFrame:
    """LIM-1: the first ``n`` rows by ``order_col`` (top-n, not a full sort)."""
    return df.orderBy(order_col).limit(n)


def avg_by_key(df: DataFrame, key: str = "k", value: str = "v") -> DataFrame:
    """AGG-6: ``(key, avg_value)`` per key."""
    return df.groupBy(F.col(key).alias("key")).agg(exact_avg(value).alias("avg_value"))


def parse_longs(lines: DataFrame, names: tuple[str, ...] = ("id", "x", "y", "z"),
                col: str = "value", sep: str = ",") -> DataFrame:
    """PRJ-5: the leading fields of each line as strict bigint columns ``names``."""
    return lines.select(*parse_long_fields(F.col(col), list(names), sep))


def xyz_by_id(rows: DataFrame) -> DataFrame:
    """AGG-7: per ``id``: ``max_y``, ``min_z`` and ``avg_x`` in one aggregate."""
    return rows.groupBy("id").agg(
        F.max("y").alias("max_y"),
        F.min("z").alias("min_z"),
        exact_avg("x").alias("avg_x"),
    )


def parse_status(lines: DataFrame, col: str = "value") -> DataFrame:
    """PRJ-6: the status code (first field, strict int) of each log line, column ``code``."""
    return lines.select(parse_status_code(F.col(col)))


def status_counts(codes: DataFrame) -> DataFrame:
    """AGG-8: ``total`` rows, ``n_400`` and ``n_200``; other codes count only in total."""
    code = F.col("code")
    return codes.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(code == 400).alias("n_400"),
        F.count_if(code == 200).alias("n_200"),
    )

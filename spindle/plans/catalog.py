"""Name -> query builder and name -> oracle SQL, as consumed by ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spindle.plans.batch import BATCH_QUERIES
from spindle.plans.oracle import BATCH_SQL, STREAM_SQL
from spindle.plans.stream import STREAM_QUERIES

QueryFn = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = dict(BATCH_QUERIES)
    out.update(STREAM_QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out = dict(BATCH_SQL)
    out.update(STREAM_SQL)
    return out

"""Size-checked broadcast for the small side of a join (JON-1, JON-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, NumericType, StringType

# Limits for shipping a lookup table to every executor.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def _row_bytes(name: str, kind: DataType) -> Column:
    """Bytes of one column's value: its octets, eight for a number, the JSON text of anything nested."""
    value = F.col(f"`{name}`")
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, NumericType):
        return F.lit(8)
    return F.coalesce(F.octet_length(F.to_json(F.struct(value.alias("v")))), F.lit(0)) + 8


def checked_broadcast(small: DataFrame, key: str,
                      max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``small`` for broadcast only if it is proven small.

    One aggregate job counts the lookup's rows and the bytes of all its columns, a row per
    task, while the plan is being built.  Within both limits the side gets a broadcast hint;
    beyond them it is returned unchanged and the planner uses a shuffled join (sort-merge, or
    a broadcast chosen by AQE from runtime statistics).  ``key`` must be one of its columns.
    """
    if key not in small.columns:
        raise ValueError(f"no column {key!r} to join on")
    row = sum((_row_bytes(f.name, f.dataType) for f in small.schema.fields), F.lit(0))
    probe = small.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("bytes"),
    ).first()
    if probe["n"] <= max_rows and probe["bytes"] <= max_bytes:
        return F.broadcast(small)
    return small

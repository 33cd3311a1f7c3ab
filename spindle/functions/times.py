"""Time-zone independent conversions for ``timestamp_ntz`` event times.

Watermarks need a ``timestamp`` (instant) column.  Casting ``timestamp_ntz`` to
``timestamp`` would read the wall time in the session time zone; these helpers
read it as UTC instead, so results do not depend on the session setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def ntz_epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a ``timestamp_ntz`` read as UTC wall time."""
    whole = F.unix_timestamp(ts).cast("long") * F.lit(1_000_000)
    frac = (F.date_part(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("long") % F.lit(1_000_000)
    return whole + frac


def ntz_to_instant(ts: Column) -> Column:
    """``timestamp_ntz`` -> ``timestamp`` holding the same wall time in UTC."""
    return F.timestamp_micros(ntz_epoch_micros(ts))


def instant_to_ntz(ts: Column) -> Column:
    """Inverse of :func:`ntz_to_instant`: the UTC wall time of an instant as ``timestamp_ntz``."""
    secs = (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def ntz_epoch_millis(ts: Column) -> Column:
    """Milliseconds since the epoch of a ``timestamp_ntz`` read as UTC (floor)."""
    return F.floor(ntz_epoch_micros(ts) / F.lit(1000)).cast("long")

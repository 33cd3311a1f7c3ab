"""Strict integer parsing of delimited text lines (PRJ-5, PRJ-6).

A malformed or missing field fails the job (``raise_error``), as a strict parser
would; values are never silently turned into NULL.  The result is the same with
ANSI mode on or off.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted integer syntax (optional sign, ASCII digits only).
INTEGER_SYNTAX = r"^[+-]?[0-9]+$"


def strict_long(field: Column, what: str = "field", type_name: str = "bigint") -> Column:
    """Cast a string field to an integer type or fail the task with a clear message."""
    parsed = field.try_cast(type_name)
    ok = field.isNotNull() & field.rlike(INTEGER_SYNTAX) & parsed.isNotNull()
    msg = F.concat(F.lit(f"malformed {what}: "), F.coalesce(F.concat(F.lit("'"), field, F.lit("'")),
                                                           F.lit("<missing>")))
    return F.when(ok, parsed).otherwise(F.raise_error(msg).cast(type_name))


def parse_long_fields(line: Column, names: list[str], sep: str = ",") -> list[Column]:
    """The first ``len(names)`` fields of a ``sep``-delimited line as strict bigints.

    Fields past the last name are ignored; a missing one fails.
    """
    parts = F.split(line, sep, -1)
    return [strict_long(F.get(parts, i), name).alias(name) for i, name in enumerate(names)]


def parse_status_code(line: Column, sep: str = ",") -> Column:
    """First field of a log line as a strict int (PRJ-6)."""
    return strict_long(F.get(F.split(line, sep, -1), 0), "status code", "int").alias("code")

"""SNK-1: key/value results as ``(key,value)`` text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.functions.escapes import escape_field, parsed_field, unescape_field

_PAIR = r"(?s)^\((.*),([^,]*)\)$"


def save_pairs_text(df: DataFrame, path: str, key: str, value: str) -> None:
    """Write one ``(key,value)`` line per row; fails if ``path`` already exists.

    Values use Spark's string cast (shortest round-trip form for doubles, e.g.
    ``3.0``, ``4.5``).  Backslashes and line breaks inside a field are escaped and NULL
    is written ``\\N``, so every row is one line.  Each task writes its own part file.
    """
    line = F.concat(F.lit("("), escape_field(F.col(key)), F.lit(","), escape_field(F.col(value)), F.lit(")"))
    df.select(line.alias("value")).write.mode("errorifexists").text(path)


def read_pairs_text(spark: SparkSession, path: str) -> DataFrame:
    """Parse ``(key,value)`` lines back into string columns ``key`` and ``value``.

    The value is the text after the last comma, so keys may contain commas.  A line of
    another form fails the job.
    """
    lines = spark.read.text(path)
    return lines.select(unescape_field(parsed_field(F.col("value"), _PAIR, 1)).alias("key"),
                        unescape_field(parsed_field(F.col("value"), _PAIR, 2)).alias("value"))

"""Line sources (SRC-1) and the stop-word lookup (SRC-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.functions.tokens import text_lines

LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])
WORD_SCHEMA = T.StructType([T.StructField("word", T.StringType(), True)])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) at ``path`` as one row per line, column ``value`` (SRC-1).

    Line breaks are ``\\n``, ``\\r`` or ``\\r\\n``; a file's final break does not
    start an extra empty line.
    """
    return spark.read.text(path)


def document_lines(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Explode a text column into its lines, column ``value``, as if each row were a file.

    ``keep`` names columns carried next to every line (e.g. a document id).
    """
    return docs.select(*keep, F.explode(text_lines(F.col(text_col))).alias("value"))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Stop-word file as a one-column table ``word``: exact lines, no trim, no case fold."""
    return spark.read.text(path).select(F.col("value").alias("word"))


def stopword_frame(spark: SparkSession, words: list[str] | tuple[str, ...]) -> DataFrame:
    """A small in-memory stop list (its size is known on the driver), built from literals."""
    if not words:
        return spark.createDataFrame([], WORD_SCHEMA)
    return spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in words])).alias("word"))

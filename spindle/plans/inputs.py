"""Inputs the queries derive from the given tables.

The reference programs read text files (prose, a status log, CSV records) that are
not bundled; the catalogue derives the same shapes from the driver's tables so
every query grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.operators.layout import spread
from spindle.session import scratch_path
from spindle.sources.files import document_lines, read_stopwords, stopword_frame
from spindle.sources.tables import load_table

# The small stop list the catalogue queries use (a subset of a
# common English list; any stop-word file can be passed to the operators instead).
CATALOG_STOPWORDS = ("the", "and", "of", "to", "a", "in", "is")

# Status code given to each event type in the derived access log.
STATUS_BY_EVENT = {"error": 400, "view": 200}
OTHER_STATUS = 500


# Session setting of the caller: round-robin the scans of CPU-heavy queries over so many
# partitions.  For inputs of a few large row groups, such as the test files; unset, scans
# keep their splits and no shuffle is added.
SPREAD_KEY = "spindle.spread.partitions"


def _spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    wanted = spark.conf.get(SPREAD_KEY, None)
    return spread(df, int(wanted) if wanted else None)


def prose_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents.text as text lines, column ``value``."""
    return document_lines(_spread(spark, load_table(spark, sf_dir, "documents", "text")))


def sliced_prose_lines(spark: SparkSession, sf_dir: str, n_slices: int) -> DataFrame:
    """documents.text as text lines with the document's ``slice`` (doc_id mod ``n_slices``)."""
    docs = _spread(spark, load_table(spark, sf_dir, "documents", "doc_id", "text"))
    return document_lines(docs.withColumn("slice", F.pmod("doc_id", F.lit(n_slices)).cast("int")), keep=("slice",))


_STOPWORD_FILES: dict[str, str] = {}


def catalog_stopwords(spark: SparkSession) -> DataFrame:
    """The catalogue's stop list, read as a stop-word file (SRC-4).

    The fixed list is written once per application as a one-word-per-line text
    file in the shared folder, then read like any stop-word file.
    """
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # sessions without a SparkContext handle: write per call
        app = None
    path = _STOPWORD_FILES.get(app) if app else None
    if path is None:
        path = scratch_path(spark, "stopwords")
        stopword_frame(spark, CATALOG_STOPWORDS).coalesce(1).write.text(path)
        if app:
            _STOPWORD_FILES[app] = path
    return read_stopwords(spark, path)


def status_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as access-log lines ``"<code>,<user_id>"``, column ``value``."""
    ev = load_table(spark, sf_dir, "events", "event_type", "user_id")
    code = F.lit(OTHER_STATUS)
    for event_type, status in reversed(list(STATUS_BY_EVENT.items())):
        code = F.when(F.col("event_type") == event_type, F.lit(status)).otherwise(code)
    return ev.select(F.concat_ws(",", code.cast("string"), F.col("user_id").cast("string")).alias("value"))


def supplier_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as CSV records ``"id,x,y,z"`` = suppkey, quantity, partkey, orderkey."""
    li = _spread(spark, load_table(spark, sf_dir, "lineitem", "l_suppkey", "l_quantity",
                                   "l_partkey", "l_orderkey"))
    return li.select(F.concat_ws(
        ",", F.col("l_suppkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string"),
        F.col("l_partkey").cast("string"), F.col("l_orderkey").cast("string")).alias("value"))

r"""Per-batch sinks for ``foreachBatch`` (SNK-2..8).

Every writer is keyed by the micro-batch id, so a batch that is replayed after a
failure overwrites its own output instead of adding to it (exactly-once results
on top of the at-least-once ``foreachBatch`` contract).  Batch ids start at 0 in every
checkpoint, so tables that several programs share are keyed by a writer name as well,
one per checkpoint.  Writes are ordinary DataFrame writes: one task per partition, no
connection handling in user code.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.functions.escapes import escape_field, parsed_field, unescape_field
from spindle.sources.folders import file_exists, list_folders

BatchFn = Callable[[DataFrame, int], None]


def save_batch_dir(df: DataFrame, prefix: str, batch_id: int, sep: str = "\t") -> None:
    r"""SNK-2: write one batch as ``sep``-joined text lines into ``<prefix>-<batch_id>``.

    Fields are not quoted, like in a key/value text output format; backslashes and line
    breaks inside a field are escaped and NULL is ``\N``, so every row is one line.  A
    program needs a prefix of its own.
    """
    line = F.concat_ws(sep, *[escape_field(F.col(c)) for c in df.columns])
    df.select(line.alias("value")).write.mode("overwrite").text(f"{prefix}-{batch_id}")


def read_batch_dirs(spark: SparkSession, prefix: str, schema: T.StructType | str,
                    free_col: str | None = None, sep: str = "\t") -> DataFrame:
    """Read every ``<prefix>-<batch_id>`` folder back as one typed table.

    One column (``free_col``, by default the first string column) may itself
    contain ``sep``; the fields before it are taken from the start of the line and
    the fields after it from the end.  A line of another form fails the job.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    names = [f.name for f in schema.fields]
    if free_col is None:
        free_col = next((f.name for f in schema.fields if isinstance(f.dataType, T.StringType)),
                        names[-1])
    k = names.index(free_col)
    s = re.escape(sep)
    fixed = f"([^{s}]*)"
    pattern = "(?s)^" + s.join([fixed] * k + ["(.*)"] + [fixed] * (len(names) - k - 1)) + "$"
    lines = spark.read.text(f"{prefix}-*")
    return lines.select(*[unescape_field(parsed_field(F.col("value"), pattern, i + 1)).cast(f.dataType).alias(f.name)
                          for i, f in enumerate(schema.fields)])


def write_batch_partition(df: DataFrame, path: str, batch_id: int, writer: str | None = None) -> None:
    """Write one batch as partition ``batch_id=<id>`` of a parquet table (dynamic overwrite).

    With ``writer`` the partition is ``writer=<name>/batch_id=<id>``.
    """
    keys = ["batch_id"] if writer is None else ["writer", "batch_id"]
    tagged = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    if writer is not None:
        tagged = tagged.withColumn("writer", F.lit(writer))
    (tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*keys).parquet(path))


def console(df: DataFrame, batch_id: int, rows: int = 10, header: str | None = None) -> None:
    """SNK-4: print a header with the batch's time (STR-10) and the first ``rows`` rows of its result.

    Only ``rows`` rows and one timestamp reach the driver (``show`` takes a limit).
    """
    from spindle.streaming.run import batch_time_ms

    if header is None:
        time_ms = df.sparkSession.range(1).select(batch_time_ms().alias("t")).first()["t"]
        header = f"========= batch {batch_id} at {time_ms} ========="
    print(header)
    df.show(rows, truncate=False)


def console_writer(rows: int = 10, header_fn: Callable[[int], str] | None = None) -> BatchFn:
    """SNK-3/4 as a ``foreachBatch`` function printing the first ``rows`` rows per batch."""
    return lambda df, bid: console(df, bid, rows, header_fn(bid) if header_fn else None)


# SNK-5: keyed counters.  Under <path>/increments each batch's increments are a partition
# (writer, batch_id): re-applying a batch replaces its partition.  A snapshot in
# <path>/snapshots/v<number> holds folded totals, and per writer the highest batch in them;
# it is valid once its `folded` table is complete, which is written last.

_INCREMENT = "key string, n long, writer string, batch_id long"


def increment_counts(df: DataFrame, path: str, batch_id: int, key: str = "word",
                     value: str = "n", writer: str = "main") -> None:
    """Apply ``total[key] += value`` for every row of one batch (idempotent per writer and batch id).

    ``writer`` names the program's checkpoint: two programs on one table need two names.
    A batch that a snapshot has folded already is ignored by the readers.
    """
    write_batch_partition(df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("long").alias("n")),
                          f"{path}/increments", batch_id, writer)


def _snapshot(spark: SparkSession, path: str) -> tuple[int, DataFrame, DataFrame]:
    """Number, totals and folded batches of the newest complete snapshot (0: none yet)."""
    for name in sorted(list_folders(spark, f"{path}/snapshots"), key=lambda n: -int(n[1:])):
        base = f"{path}/snapshots/{name}"
        if file_exists(spark, f"{base}/folded/_SUCCESS"):
            return (int(name[1:]), spark.read.schema("key string, n long").parquet(f"{base}/totals"),
                    spark.read.schema("writer string, folded long").parquet(f"{base}/folded"))
    none = spark.createDataFrame([], "writer string, folded long")
    return 0, spark.createDataFrame([], "key string, n long"), none


def _increments(spark: SparkSession, path: str, folded: DataFrame) -> DataFrame:
    """Increments that the snapshot does not hold; ``folded`` has one row per writer."""
    rows = spark.read.schema(_INCREMENT).parquet(f"{path}/increments")
    return (rows.join(F.broadcast(folded), "writer", "left")
            .filter(F.col("folded").isNull() | (F.col("batch_id") > F.col("folded"))))


def counter_totals(spark: SparkSession, path: str) -> DataFrame:
    """Current counter values ``(key, total)``: the snapshot's totals plus later increments."""
    _, totals, folded = _snapshot(spark, path)
    return (totals.unionByName(_increments(spark, path, folded).select("key", "n"))
            .groupBy("key").agg(F.sum("n").alias("total")))


def compact_counters(spark: SparkSession, path: str) -> None:
    """Fold all increments applied so far into a new snapshot; readers take it once it is complete.

    Batches being written meanwhile stay out: the batches to fold are fixed first.
    """
    number, totals, folded = _snapshot(spark, path)
    later = _increments(spark, path, folded)
    upto = {r["writer"]: r["upto"] for r in later.groupBy("writer").agg(F.max("batch_id").alias("upto")).collect()}
    done = {r["writer"]: r["folded"] for r in folded.collect()} | upto  # a row per writer
    limits = spark.createDataFrame(sorted(done.items()), "writer string, folded long")
    fixed = later.drop("folded").join(F.broadcast(limits), "writer").filter("batch_id <= folded")
    base = f"{path}/snapshots/v{number + 1}"
    (totals.unionByName(fixed.select("key", "n")).groupBy("key").agg(F.sum("n").alias("n"))
     .write.mode("overwrite").parquet(f"{base}/totals"))
    limits.coalesce(1).write.mode("overwrite").parquet(f"{base}/folded")


# SNK-6: time-keyed cells (time_ms, word) -> n.  Row key = time of the batch; a replayed
# batch rewrites its own rows, and readers take the last write of a cell.

def append_timed_counts(df: DataFrame, path: str, batch_id: int, time_ms_col: str = "time_ms",
                        key: str = "word", value: str = "n", writer: str = "main") -> None:
    write_batch_partition(df.select(F.col(time_ms_col).cast("long").alias("time_ms"),
                                    F.col(key).alias("word"), F.col(value).cast("long").alias("n")),
                          path, batch_id, writer)


def timed_cells(spark: SparkSession, path: str) -> DataFrame:
    """``(time_ms, word, n)``: one row per cell, the last write wins (highest batch, then writer)."""
    cells = spark.read.schema("time_ms long, word string, n long, writer string, batch_id long").parquet(path)
    return cells.groupBy("time_ms", "word").agg(F.max_by("n", F.struct("batch_id", "writer")).alias("n"))


def latest_per_key(spark: SparkSession, path: str, keys: tuple[str, ...], value: str) -> DataFrame:
    """Latest value per key of an update-mode batch log (``max_by`` on the batch id)."""
    log = spark.read.parquet(path)
    return log.groupBy(*keys).agg(F.max_by(value, "batch_id").alias(value))

"""Running totals tied to records (STR-7) and a caller's state function (STF-1).

Both run inside ``foreachBatch`` on tables keyed by the batch id, so a replayed batch
rewrites its own rows; both aggregate before the shuffle, so a hot key costs one row per
map task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.functions.tokens import space_tokens
from spindle.streaming.counts import update_totals
from spindle.streaming.sinks import write_batch_partition

StateFn = Callable[[Column, Column], Column]


def record_words(lines: DataFrame, keep: tuple[str, ...], col: str = "value") -> DataFrame:
    """PRJ-1 with each token's place in its line: the ``keep`` columns, ``pos`` and ``word``."""
    return lines.select(*keep, F.posexplode(space_tokens(F.col(col))).alias("pos", "word"))


def _batch_of(df: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Write a batch's rows under its id and read them back, so that later steps see one and the same layout."""
    write_batch_partition(df, path, batch_id)
    schema = T.StructType([*df.schema.fields, T.StructField("batch_id", T.LongType())])
    return df.sparkSession.read.schema(schema).parquet(path).filter(F.col("batch_id") == batch_id).drop("batch_id")


def record_totals(words: DataFrame, batch_id: int, path: str, order: tuple[str, ...], parts: int | None = None,
                  full_every: int = 16) -> DataFrame:
    """STR-7: every record of a micro-batch with its word's running total, in the order of ``order``.

    ``words`` has the ``order`` columns (one record each, e.g. an id and the place in the
    line) and ``word``.  Totals are prefix counts over (batch, part, place in the part):

    1. records are dealt by ranges of ``order`` to ``parts`` tasks, and written under ``path``;
    2. each word is counted per part; a window over at most ``parts`` rows a word gives the
       count before each part, and ``update_totals`` the count before the batch;
    3. inside a (word, part) the place is a row number.

    A hot word is therefore numbered in ``parts`` pieces.  Rows with equal ``order`` have
    consecutive totals in no fixed order.
    """
    spark = words.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = _batch_of(words.select(*order, "word").repartitionByRange(parts, *order)
                       .withColumn("part", F.spark_partition_id()), f"{path}/placed", batch_id)
    totals = update_totals(placed.select("word"), batch_id, f"{path}/totals", full_every)
    earlier = Window.partitionBy("word").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("word", "part").agg(F.count(F.lit(1)).alias("n"))
              .join(totals.select("word", "prev"), "word")
              .select("word", "part", (F.col("prev") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("start")))
    place = F.row_number().over(Window.partitionBy("word", "part").orderBy(*order))
    return (placed.withColumn("place", place).join(starts, ["word", "part"])
            .select(*order, "word", (F.col("start") + F.col("place")).alias("total")))


def update_state(rows: DataFrame, batch_id: int, path: str, key: str, partial: Column, update: StateFn, state_type: str,
                 full_every: int = 16) -> DataFrame:
    """STF-1: apply a caller's state function to a micro-batch; ``(key, old, partial, state)`` of its keys.

    ``partial`` is an aggregate over a key's rows of the batch (partial before the shuffle);
    ``update(old, partial)`` is a column: the new state from the state before the batch
    (null for a new key) and the batch's aggregate.  It is evaluated for whole columns,
    inside the JVM for built-in functions or in Arrow batches for a Pandas UDF, with no
    call per key.  States of earlier batches come from the log at ``path``, which holds
    all keys in every ``full_every``-th batch, else the keys of its batch.
    """
    spark = rows.sparkSession
    counted = rows.groupBy(key).agg(partial.alias("partial"), F.lit(True).alias("seen"))
    schema = T.StructType([rows.schema[key], T.StructField("state", T._parse_datatype_string(state_type)),
                           T.StructField("seen", T.BooleanType()), T.StructField("batch_id", T.LongType())])
    if batch_id:
        last_full = (batch_id - 1) // full_every * full_every
        before = (spark.read.schema(schema).parquet(path).filter(F.col("batch_id").between(last_full, batch_id - 1))
                  .groupBy(key).agg(F.max_by("state", "batch_id").alias("old")).withColumnRenamed(key, "_known"))
        joined = counted.join(before, F.col(key).eqNullSafe(F.col("_known")), "left" if batch_id % full_every else "full")
        joined = joined.withColumn(key, F.coalesce(key, "_known")).drop("_known")
    else:
        joined = counted.withColumn("old", F.lit(None).cast(state_type))
    new = F.when(F.col("seen"), update(F.col("old"), F.col("partial"))).otherwise(F.col("old")).cast(state_type)
    out = _batch_of(joined.select(key, new.alias("state"), F.coalesce("seen", F.lit(False)).alias("seen"), "old", "partial"),
                    path, batch_id)
    return out.filter("seen").select(key, "old", "partial", "state")


def latest_states(df: DataFrame) -> DataFrame:
    """The last state per key from a state log (key, state, batch_id)."""
    key = df.columns[0]
    return df.groupBy(key).agg(F.max_by("state", "batch_id").alias("state"))

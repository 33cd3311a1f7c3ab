"""Uniform shuffle into shards of exact sizes through a hypergeometric matrix.

1. The rows are written once, so every row has a fixed partition and position.
2. How many rows of each partition go to each shard is drawn.  The counts follow the
   multivariate hypergeometric law, which is the law of these counts under a uniformly
   random permutation, so every row sum is the partition's size and every column sum the
   shard's size.  The driver draws for about sqrt(partitions) groups of partitions, the
   tasks for the partitions of a group; only partition sizes reach the driver.
3. Each partition is permuted and dealt out by its row of the matrix, without an
   exchange: a keyed permutation gives a row's place from its number, so a task deals
   whatever rows it reads.
4. The rows are exchanged and permuted again within each shard, which gives the slot.

Law ``rows``: shard sizes differ by one at most.

Defined cases: null and empty texts are rows like others; repeated rows are dealt
one by one (they are told apart by position); an empty table gives an empty result;
fewer rows than shards leaves some shards empty; extra columns are kept, and columns
named like the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from spindle.llm.common import body, empty_frame, free_name, keep
from spindle.llm.shingles import mix

ROWS_PER_BUCKET = 200_000
PART_SHIFT = 33  # monotonically_increasing_id: partition number, then 33 bits of place
FEISTEL_ROUNDS = 6


def shard_sizes(n_rows: int, n_shards: int) -> list[int]:
    """Shard sizes at most one apart; the first shards take the remainder."""
    return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` taken without replacement, for populations of any size.

    Inverts the distribution function around the mode; beyond 12 standard deviations
    (plus 30) the mass is below double precision.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    share = good / total
    sd = (draws * share * (1 - share) * (total - draws) / max(total - 1, 1)) ** 0.5
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    reach = int(12 * sd) + 30
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    steps = (np.log(good - k[:-1]) + np.log(draws - k[:-1])
             - np.log(k[:-1] + 1) - np.log(bad - draws + k[:-1] + 1))
    log_mass = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(log_mass - log_mass.max()))
    at = int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))
    return int(k[min(at, len(k) - 1)])


def communication_matrix(partition_rows: list[int], sizes: list[int], seed: int | list[int]) -> list[list[int]]:
    """Rows sent from each partition to each shard, one list per partition."""
    rng = np.random.default_rng(seed)
    room, matrix = list(sizes), []
    for rows in partition_rows:
        left, free, counts = rows, sum(room), []
        for shard, size in enumerate(room):
            got = hypergeometric(rng, size, free - size, left)
            counts.append(got)
            left, free = left - got, free - size
            room[shard] -= got
        matrix.append(counts)
    return matrix


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The image of each ``index`` under a keyed permutation of 0 .. n - 1 (Feistel rounds, walked until below n).

    A row's place after the permutation follows from its number alone, so any task can tell it.
    """
    half = np.uint64(max(1, -(-(n - 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.uint64(key % 2**64) + np.arange(FEISTEL_ROUNDS, dtype=np.uint64))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        return (left << half) | right

    out = once(index.astype(np.uint64))
    while (beyond := out >= n).any():
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


class Deal:
    """Shards of numbered rows, drawn in two levels: groups of partitions by the driver, partitions by the tasks.

    ``sizes`` are the rows of the partitions.  The driver draws a row of the matrix for each
    of about sqrt(partitions) groups; a task draws a group's partitions when it meets one.
    """

    def __init__(self, sizes: np.ndarray, n_shards: int, seed: int):
        self.sizes, self.seed, self.width = sizes, seed, max(1, int(np.ceil(len(sizes) ** 0.5)))
        groups = [int(sizes[i:i + self.width].sum()) for i in range(0, len(sizes), self.width)]
        self.groups = communication_matrix(groups, shard_sizes(int(sizes.sum()), n_shards), seed)
        self._ends: dict[int, np.ndarray] = {}

    def ends(self, part: int) -> np.ndarray:
        """Running totals of a partition's rows by shard."""
        if part not in self._ends:
            group = part // self.width
            low = group * self.width
            rows = communication_matrix(self.sizes[low:low + self.width].tolist(), self.groups[group],
                                        [self.seed, 1 + group])
            self._ends = {low + i: np.cumsum(r) for i, r in enumerate(rows)}  # one group at a time
        return self._ends[part]

    def shards(self, part: int, index: np.ndarray) -> np.ndarray:
        place = permuted(index, int(self.sizes[part]), self.seed * 1_000_003 + part)
        return np.searchsorted(self.ends(part), place, side="right")


def _dealer(deal: Deal, pos: str, shard: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(pos).to_numpy()
            part, out = at >> PART_SHIFT, np.zeros(len(at), np.int32)
            for p in np.unique(part):
                here = part == p
                out[here] = deal.shards(int(p), at[here] & ((1 << PART_SHIFT) - 1))
            yield batch.append_column(shard, pa.array(out, pa.int32()))

    return run


def shuffle_into_shards(df: DataFrame, n_shards: int, seed: int = 7,
                        rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df`` plus ``shard`` (int, 0 to n_shards - 1) and ``slot`` (long, gapless from 0 in each shard)."""
    df = df.drop("shard", "slot")
    pos, second, bucket, base = (free_name(df, x) for x in ("_pos", "_second", "_bucket", "_base"))
    # partition and place in it, as written: fixed from here on, however the files are split later
    rows = keep(df.withColumn(pos, F.monotonically_increasing_id()), "shard-in")
    part = F.shiftright(F.col(pos), PART_SHIFT)
    found = {r["part"]: r["count"] for r in rows.groupBy(part.alias("part")).count().collect()}  # a row per partition
    if not found:
        return rows.drop(pos).withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long"))
    sizes = np.zeros(max(found) + 1, np.int64)
    sizes[list(found)] = list(found.values())
    total = int(sizes.sum())
    schema = StructType([*rows.schema.fields, StructField("shard", IntegerType())])
    local = rows.mapInArrow(_dealer(Deal(sizes, n_shards, seed), pos, "shard"), schema)
    buckets = max(1, -(-total // (n_shards * rows_per_bucket)))
    dealt = keep(local.withColumn(second, F.xxhash64(F.lit(seed), F.lit(2), pos))
                 .withColumn(bucket, F.pmod(F.col(second), F.lit(buckets)).cast("int")), "shard-dealt")
    counts = dealt.groupBy("shard", bucket).count()
    before = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(base))
    inner = Window.partitionBy("shard", bucket).orderBy(second, pos)
    return (dealt.withColumn("slot", F.row_number().over(inner).cast("long") - 1)
            .join(bases, ["shard", bucket])
            .withColumn("slot", F.col("slot") + F.col(base))
            .select(*df.columns, "shard", "slot"))


def document_shards(documents: DataFrame, n_shards: int = 24, seed: int = 7) -> DataFrame:
    """The digest of every document's place: sizes are UTF-8 bytes of the text plus 8."""
    if not documents.columns:
        return empty_frame(documents.sparkSession, "doc_id bigint")
    narrow = documents.select(
        F.col("doc_id"),
        (F.octet_length(body()) + 8).cast("long").alias("size"),
        F.crc32(F.encode(body(), "UTF-8")).alias("text_crc32"))
    return (shuffle_into_shards(narrow, n_shards, seed)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))

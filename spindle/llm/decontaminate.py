r"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

Only DataFrame and SQL functions.  Words are maximal runs of ASCII letters and digits and
non-ASCII characters of the lower-cased text; a shingle is five consecutive words (an
item of fewer words has one shingle, all its words).

1. Windows.  A window of an item's length whose weighted-shingle similarity to the item
   is ``similarity`` or more misses at most (1 - similarity) of the item's shingle weight,
   so it holds one of any shingles that weigh more than that.  The item's rarest such
   shingles (by frequency in the benchmark) are looked up in every position of every
   text.  A hit gives the window aligned with the item and those shifted by up to
   (1 - similarity) / (1 + similarity) of the item's shingles, moved inside the text's
   bounds.  A copy that keeps the item's order cannot be shifted further: at the threshold
   that share of the window is foreign or missing at most, so before the hit too.  Of a
   copy whose parts are rearranged, only windows at these starts are tried.
2. Fingerprints.  Each window and item gets a 64-bit SimHash of its shingles, weighted by
   their counts.
3. Multi-index.  Fingerprints are cut into ``BLOCK_BITS``; two within ``RADIUS`` bits agree
   in some block up to ``RADIUS // blocks`` bits.  Items are indexed under all block values
   that close, windows look up their own blocks, so all pairs of the same length within
   the radius meet.
4. Exact check: sum of least over sum of greatest shingle counts.

Equal texts are searched once, and equal items too.

Defined cases: null and empty texts, and items without words, match nothing; repeated
document rows each carry the result; a null doc_id or item_id is kept as such; an empty
table on either side gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spindle.llm.common import body, free_name, keep
from spindle.operators.joins import checked_broadcast

SHINGLE, SIMILARITY = 5, 0.8
BLOCK_BITS = (11, 11, 11, 11, 10, 10)
RADIUS = 17  # a pair at similarity 0.8 differs in 10 of 64 bits on average, with a deviation of 3
NOT_WORD = r"[^a-z0-9\x{80}-\x{10FFFF}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NOT_WORD, -1), "")


def _shingles(hashes: Column, size: int) -> Column:
    """The hash of each ``size`` consecutive words; an empty array for shorter texts."""
    at = F.sequence(F.lit(0), F.size(hashes) - size)
    made = F.transform(at, lambda i: F.xxhash64(*(hashes[i + j] for j in range(size))))
    return F.when(F.size(hashes) >= size, made).otherwise(F.array().cast("array<bigint>"))


def _hashed(df: DataFrame) -> DataFrame:
    """Replaces ``text`` by the hashes of its words."""
    return df.withColumn("w", F.transform(words(F.col("text")), lambda x: F.xxhash64(x))).drop("text")


def simhash(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fp``, the 64-bit SimHash of the rows' ``shingles``; an occurrence is a unit of weight."""
    votes = df.select(*keys, F.explode("shingles").alias("h"))
    sums = votes.groupBy(*keys).agg(*(
        F.sum(F.shiftrightunsigned("h", b).bitwiseAND(1) * 2 - 1).alias(f"b{b}") for b in range(64)))
    bits = [F.when(F.col(f"b{b}") > 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
            for b in range(64)]
    fp = bits[0]
    for bit in bits[1:]:
        fp = fp.bitwiseOR(bit)
    return sums.select(*keys, fp.alias("fp"))


def _blocks() -> list[tuple[int, int]]:
    """Shift and width of each block."""
    shifts = [sum(BLOCK_BITS[:n]) for n in range(len(BLOCK_BITS))]
    return list(zip(shifts, BLOCK_BITS, strict=True))


def _block_value(shift: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1)


def indexed(items: DataFrame) -> DataFrame:
    """Each item fingerprint under every (block, value) within its share of the radius."""
    near = RADIUS // len(BLOCK_BITS)

    def values(shift: int, width: int) -> Column:
        flips = [sum(1 << b for b in bits) for n in range(near + 1) for bits in combinations(range(width), n)]
        return F.transform(F.array(*map(F.lit, flips)), lambda f: _block_value(shift, width).bitwiseXOR(f.cast("long")))

    entry = F.explode(F.array(*(F.struct(F.lit(n).alias("block"), values(*b).alias("values"))
                                for n, b in enumerate(_blocks()))))
    return (items.withColumn("entry", entry)
            .select("item", "length", F.col("fp").alias("item_fp"), F.col("entry.block").alias("block"),
                    F.explode("entry.values").alias("value")))


def matches(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(text_key, item, start, similarity): the best window, by word number, of each text and item that match.

    ``text_key`` is the MD5 of the text, ``item`` that of the item's words.
    """
    items = keep(_hashed(benchmark.select(body().alias("text"), F.md5(F.encode(F.array_join(words(body()), " "), "UTF-8"))
                                          .alias("item")).dropDuplicates(["item"])).filter(F.size("w") > 0)
                 .withColumn("length", F.size("w")), "bench-items")
    sizes = sorted(r[0] for r in items.select(F.least("length", F.lit(SHINGLE))).distinct().collect())  # 1 to 5
    wanted = None
    for size in sizes:
        own = items.filter(F.least("length", F.lit(SHINGLE)) == size).select("item", "length", _shingles(F.col("w"), size).alias("shingles"))
        wanted = own if wanted is None else wanted.union(own)
    if wanted is None:
        return documents.sparkSession.createDataFrame([], "text_key string, item string, start int, similarity double")
    item_shingles = keep(wanted, "bench-shingles")
    spots = item_shingles.select("item", "length", F.size("shingles").alias("total"), F.posexplode("shingles").alias("place", "h"))
    counted = spots.groupBy("item", "total", "h").agg(F.count(F.lit(1)).alias("weight"))
    by_rarity = Window.partitionBy("item").orderBy("spread", "h").rowsBetween(Window.unboundedPreceding, -1)
    telling = (counted.join(counted.groupBy("h").agg(F.count(F.lit(1)).alias("spread")), "h")
               .withColumn("before", F.coalesce(F.sum("weight").over(by_rarity), F.lit(0)))
               .filter(F.col("before") <= (1 - similarity) * F.col("total") + 1e-9).select("item", "h"))
    lookup = keep(spots.join(telling, ["item", "h"]).select("h", "length", "place").distinct(), "bench-lookup")

    texts = documents.select(F.md5(F.encode(body(), "UTF-8")).alias("text_key"), body().alias("text"))
    hashed = _hashed(texts)
    positions = None
    for size in sizes:
        own = hashed.select("text_key", F.size("w").alias("n"), F.posexplode(_shingles(F.col("w"), size)).alias("at", "h"))
        positions = own if positions is None else positions.union(own)
    shingles = F.col("length") - F.least("length", F.lit(SHINGLE)) + 1
    reach = F.floor(shingles * ((1 - similarity) / (1 + similarity)) + 1e-9).cast("int")
    aligned = F.col("at") - F.col("place")
    start = F.greatest(F.lit(0), F.least(F.col("start"), F.col("n") - F.col("length")))
    windows = keep(positions.join(checked_broadcast(lookup, "h"), "h")
                   .select("text_key", "length", "n", aligned.alias("aligned")).distinct()
                   .select("text_key", "length", "n", F.explode(F.sequence(F.col("aligned") - reach, F.col("aligned") + reach)).alias("start"))
                   .select("text_key", "length", start.alias("start")).distinct(), "bench-windows")

    hit = windows.select("text_key").distinct()
    found = _hashed(texts.join(checked_broadcast(hit, "text_key"), "text_key", "left_semi")
                    .groupBy("text_key").agg(F.first("text").alias("text")))
    cut = None
    for size in sizes:
        same = F.least("length", F.lit(SHINGLE)) == size
        own = (found.withColumn("all", _shingles(F.col("w"), size)).drop("w")
               .join(windows.filter(same), "text_key")
               .select("text_key", "start", "length",
                       F.slice("all", F.col("start") + 1, F.col("length") - size + 1).alias("shingles")))
        cut = own if cut is None else cut.union(own)
    windows_cut = keep(cut, "bench-cut")
    printed = simhash(windows_cut, ["text_key", "start", "length"])
    index = indexed(simhash(item_shingles, ["item", "length"]))
    look = F.explode(F.array(*(F.struct(F.lit(n).alias("block"), _block_value(*b).alias("value"))
                               for n, b in enumerate(_blocks()))))
    pairs = (printed.withColumn("look", look)
             .select("text_key", "start", "length", "fp", F.col("look.block").alias("block"), F.col("look.value").alias("value"))
             .join(index, ["length", "block", "value"])
             .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
             .select("text_key", "start", "length", "item").distinct())
    candidates = keep(pairs, "bench-pairs")

    held = (candidates.join(windows_cut, ["text_key", "start", "length"])
            .withColumn("n", F.size("shingles"))
            .select("text_key", "start", "item", "n", F.explode("shingles").alias("h"))
            .groupBy("text_key", "start", "item", "n", "h").agg(F.count(F.lit(1)).alias("held")))
    shared = (held.join(counted, ["item", "h"])
              .groupBy("text_key", "start", "item", "n", "total").agg(F.sum(F.least("held", "weight")).alias("shared")))
    value = F.col("shared") / (F.col("n") + F.col("total") - F.col("shared"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    return (shared.withColumn("similarity", value).filter(F.col("similarity") >= similarity - 1e-12)
            .groupBy("text_key", "item").agg(best)
            .select("text_key", "item", (-F.col("best.back")).cast("int").alias("start"), "best.similarity"))


def contaminated(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, start, similarity) of every document and benchmark item that match."""
    found = keep(matches(documents, benchmark, similarity), "bench-found")
    ids = (benchmark.select("item_id", F.md5(F.encode(F.array_join(words(body()), " "), "UTF-8")).alias("item")).distinct())
    docs = documents.select("doc_id", F.md5(F.encode(body(), "UTF-8")).alias("text_key"))
    return docs.join(found, "text_key").join(ids, "item").select("doc_id", "item_id", "start", "similarity")


def clean_documents(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``documents``, all columns, that match no item."""
    found = keep(matches(documents, benchmark, similarity).select("text_key").distinct(), "bench-found")
    key = free_name(documents, "_key")
    marked = documents.withColumn(key, F.md5(F.encode(body(), "UTF-8")))
    hits = checked_broadcast(found, "text_key").withColumnRenamed("text_key", key)
    return marked.join(hits, key, "left_anti").select(*(F.col(f"`{c}`") for c in documents.columns))

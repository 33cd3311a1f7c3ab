"""Suffix-array dedup of repeated byte strings.

Every byte covered by a ``length``-byte string that also starts anywhere else in the
corpus (the same document included) is removed.  Strings never cross documents, and are
judged on the input.

1. Equal texts are one class; a class with copies and ``length`` bytes or more goes whole.
2. Anchors.  Every string of ``length`` bytes holds an anchor whose hash is the least of its
   ``GRAM``-byte grams, so equal strings hold anchors with the same hash.  An anchor serves
   as long as its hash is the least, which keeps them few in periodic text too.  Anchors
   whose hash occurs once, in no gram nearby either, cannot lie in a repeat.
3. Segments.  Around each other anchor the bytes of all strings that may have chosen it
   are cut out.  Equal segments are counted and one of them goes on; all strings of a
   repeated segment are repeats.
4. Segments with the same anchor hash form a group; a group larger than ``GROUP_BYTES`` is
   split by content: segments are taken around every place of the anchor's gram in them,
   so that equal strings lie alike, and cut into two halves of their strings, grouped by
   the bytes that all strings of the half share.  Splitting ends at single strings, where
   equal ones have been merged, so any group becomes small enough.
5. Groups are dealt into shards of about ``SHARD_BYTES``.  A shard builds the suffix array
   of its segments by induced sorting and the permuted common prefixes; runs of suffixes
   sharing ``length`` bytes that hold two places of the corpus are repeats.

Defined cases: null text counts as empty; texts shorter than ``length`` bytes lose
nothing; repeated rows are copies of each other; an empty table gives an empty result;
extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.clusters import sorted_units
from spindle.llm.common import body, keep
from spindle.llm.shingles import mix, power_tables
from spindle.llm.suffixarray import common_prefixes, suffix_array
from spindle.operators.joins import checked_broadcast

LENGTH, GRAM = 400, 64
GROUP_BYTES, SHARD_BYTES = 1_000_000, 2_000_000
SEPARATOR = np.uint8(255)  # in no UTF-8 text


def anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of one text, and whether a string around the anchor may repeat
    so closely that both share it (the hash recurs within a string's length)."""
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    up, down = power_tables(len(raw) + 1)
    total = np.append(np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)]))
    hashes = mix((total[gram:] - total[:-gram]) * down[:len(raw) - gram + 1])
    width, n = length - gram + 1, len(hashes)
    rows = np.append(hashes, np.full(-n % width, np.iinfo(np.uint64).max)).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n - width + 1], ahead[width - 1:n])
    begin = np.flatnonzero(np.append(True, least[1:] != least[:-1]))  # windows with a new least hash
    end = np.append(begin[1:], len(least))
    at = begin + width - 1
    entered = hashes[at] == least[begin]
    more = []
    for i in np.flatnonzero(~(entered & (at >= end - 1))):
        window, here = int(begin[i]), int(at[i])
        if not entered[i]:
            here = at[i] = window + width - 1 - int(np.argmin(hashes[window:window + width][::-1]))
        while here < end[i] - 1:  # the anchor has left, its hash has not
            window = here + 1
            here = window + width - 1 - int(np.argmin(hashes[window:window + width][::-1]))
            more.append(here)
    at = np.unique(np.append(at, more).astype(np.int64))
    again = [np.count_nonzero(hashes[max(0, p - width):p + width] == hashes[p]) > 1 for p in at.tolist()]
    return at, hashes[at], np.array(again, bool)


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, hashes, again = [], [], []
            for text in batch.column("text").to_pylist():
                at, h, close = anchors(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), length, gram)
                places.append(at.astype(np.int32))
                hashes.append(h.view(np.int64))
                again.append(close)
            yield (batch.drop_columns(["text"]).append_column("at", pa.array(places, pa.list_(pa.int32())))
                   .append_column("hash", pa.array(hashes, pa.list_(pa.int64())))
                   .append_column("again", pa.array(again, pa.list_(pa.bool_()))))

    return run


def _cut(length: int, gram: int):
    """The segment around each repeated anchor."""
    names = ["grp", "anchor", "row", "start", "multi", "bytes"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for text, row, multi, marks in zip(*(batch.column(c).to_pylist() for c in ("text", "row", "multi", "marks")),
                                               strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for mark in marks:
                    low, high = max(0, mark["at"] + gram - length), min(len(raw), mark["at"] + length)
                    rows.append((mark["hash"], mark["at"], row, low, multi, raw[low:high]))
                    if len(rows) == 2000:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)

    return run


def _repeats(length: int):
    """Covered byte ranges of the single segments of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in sorted_units(batches, ["shard"]):
            rows = unit.column("row").to_numpy()
            starts = unit.column("start").to_numpy()
            multi = unit.column("multi").to_numpy()
            parts = [np.frombuffer(x, np.uint8) for x in unit.column("bytes").to_pylist()]
            sizes = np.array([len(x) for x in parts])
            gap = np.array([SEPARATOR], np.uint8)
            data = np.concatenate([x for part in parts for x in (part, gap)])
            begin = np.cumsum(sizes + 1) - sizes - 1
            segment = np.repeat(np.arange(len(parts)), sizes + 1)
            room = (begin + sizes)[segment] - np.arange(len(data))
            order = suffix_array(data, length)
            shared = common_prefixes(data, order)
            _, document = np.unique(rows, return_inverse=True)
            place = (document[segment].astype(np.int64) << 40) + (starts - begin)[segment] + np.arange(len(data))
            fits = room[order] >= length
            order = order[fits]  # suffixes that share `length` bytes with one that fits do fit
            joined = shared[order] >= length
            joined[1:] &= np.diff(np.flatnonzero(fits)) == 1
            if not len(order):
                continue
            joined[0] = False
            head = np.flatnonzero(~joined)
            seen = place[order]
            several = np.minimum.reduceat(seen, head) != np.maximum.reduceat(seen, head)
            several |= np.maximum.reduceat(multi[segment[order]].astype(np.int8), head) > 0
            marked = np.zeros(len(data) + 1, bool)
            marked[order[np.repeat(several, np.diff(head, append=len(order)))]] = True
            marked[:-1] &= ~multi[segment]
            edge = np.flatnonzero(marked[1:] != marked[:-1]) + 1
            edge = np.append(0, edge) if marked[0] else edge
            low, high = edge[0::2], edge[1::2] - 1 + length
            own = segment[low]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[own], pa.int64()), pa.array(starts[own] + low - begin[own], pa.int64()),
                 pa.array(starts[own] + high - begin[own], pa.int64())], names=["row", "low", "high"])

    return run


def _around_all(length: int, gram: int):
    """Segments around every place of the anchor's gram, for groups about to be split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pick, anchors_, starts, parts = [], [], [], []
            for n, (raw, anchor, start) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("bytes", "anchor", "start")),
                                                         strict=True)):
                key = raw[anchor - start:anchor - start + gram]
                at = raw.find(key)
                while at >= 0:
                    low = max(0, at + gram - length)
                    part = raw[low:at + length]
                    if len(part) >= length:
                        pick.append(n)
                        anchors_.append(start + at)
                        starts.append(start + low)
                        parts.append(part)
                    at = raw.find(key, at + 1)
            for low in range(0, len(pick), 2000):
                some = slice(low, low + 2000)
                rows = batch.select(["grp", "lo", "hi", "row", "multi"]).take(pa.array(pick[some], pa.int64()))
                yield (rows.append_column("anchor", pa.array(anchors_[some], pa.int64()))
                       .append_column("start", pa.array(starts[some], pa.int64()))
                       .append_column("bytes", pa.array(parts[some], pa.binary())))

    return run


def _halves(segments: DataFrame, length: int) -> DataFrame:
    """Each segment as two, of the first and second half of the places lo..hi, from the anchor, where strings start.

    The strings of a half share the bytes from its last start to its first end; segments
    that agree in those form a group.  A half without a whole string is left out.
    """
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")

    def half(first: Column, last: Column) -> Column:
        low = F.greatest(F.col("start"), F.col("anchor") + first)
        high = F.least(F.col("start") + F.col("n"), F.col("anchor") + last + length)
        cut = lambda a, b: F.substring(F.col("bytes"), (a - F.col("start") + 1).cast("int"), (b - a).cast("int"))
        core = cut(F.col("anchor") + last, F.col("anchor") + first + length)
        return F.when(high - low >= length, F.struct(
            F.xxhash64(first, F.col("grp"), core).alias("grp"), first.alias("lo"), last.alias("hi"),
            low.alias("start"), cut(low, high).alias("bytes")))

    parts = F.array_compact(F.array(half(F.col("lo"), mid), half(mid + 1, F.col("hi"))))
    return (segments.withColumn("part", F.explode(parts))
            .select("part.grp", "part.lo", "part.hi", "anchor", "row", "part.start", "multi", "part.bytes"))


def covered_ranges(signed: DataFrame, documents: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   group_bytes: int = GROUP_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(row, low, high): byte ranges, which may overlap, that repeats cover in the first document of each class."""
    classes = keep(signed.filter(F.col("n_bytes") >= length).groupBy("text_key")
                   .agg(F.min("row").alias("row"), (F.count(F.lit(1)) > 1).alias("multi")), "sub-classes")
    found = (signed.join(classes.select("row"), "row", "left_semi")
             .select("row", F.explode(F.arrays_zip("hash", "at", "again")).alias("mark")))
    # written, so that the join below reads plain shuffles, whose hot anchors Spark can split
    often = keep(found.groupBy(F.col("mark.hash").alias("hash"))
                 .agg(F.count(F.lit(1)).alias("n"), F.max("mark.again").alias("again")).filter("n > 1 or again")
                 .select("hash"), "sub-often")
    marks = keep(found.join(often, F.col("mark.hash") == F.col("hash"), "left_semi")
                 .groupBy("row").agg(F.collect_list("mark").alias("marks"))
                 .join(classes, "row").select("row", "multi", "text_key", "marks"), "sub-marks")
    texts = documents.select(F.md5(F.encode(body(), "UTF-8")).alias("text_key"), body().alias("text"))
    wanted = checked_broadcast(marks.select("text_key"), "text_key")
    held = texts.join(wanted, "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    segments = (held.join(marks, "text_key").select("row", "multi", "marks", "text")
                .mapInArrow(_cut(length, gram), "grp bigint, anchor bigint, row bigint, start bigint, multi boolean, bytes binary"))
    segments = segments.withColumns({"lo": F.lit(gram - length), "hi": F.lit(0)})
    covered, small, level = None, None, 0
    while True:
        rows = keep(segments.withColumn("n", F.length("bytes")).withColumn("off", F.col("anchor") - F.col("start"))
                    .withColumn("key", F.md5("bytes")).withColumn("spot", F.struct("row", "start")), f"sub-segments-{level}")
        kinds = keep(rows.groupBy("grp", "key", "off").agg(
            F.min("spot").alias("spot"), (F.min("spot") != F.max("spot")).alias("several"),
            F.max("multi").alias("multi"), F.max("n").alias("n"), F.max(F.col("hi") - F.col("lo")).alias("width")),
            f"sub-kinds-{level}")
        whole = (rows.filter("not multi").join(kinds.filter("several").select("grp", "key", "off"), ["grp", "key", "off"])
                 .select("row", F.col("start").alias("low"), (F.col("start") + F.col("n")).alias("high")))
        open_kind = (~(F.col("multi") | F.col("several"))).cast("int")
        groups = (kinds.groupBy("grp").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("size"),
                                           F.max(open_kind).alias("open"), F.max("width").alias("width"))
                  .filter(f"open = 1 and (kinds > 1 or {level} = 0)")
                  .select("grp", ((F.col("size") > group_bytes) & (F.col("width") > 0)).alias("large")))
        chosen = kinds.join(groups, "grp").select("grp", "key", "off", "spot", "several", "large")
        forward = keep(rows.join(chosen, ["grp", "key", "off", "spot"])
                       .select("grp", "lo", "hi", "anchor", "row", "start", (F.col("multi") | F.col("several")).alias("multi"),
                               "bytes", "n", "large"), f"sub-forward-{level}")
        ready = forward.filter("not large").select("grp", "row", "start", "multi", "bytes", "n")
        covered = whole if covered is None else covered.union(whole)
        small = ready if small is None else small.union(ready)
        if forward.filter("large").isEmpty():
            break
        segments, level = forward.filter("large"), level + 1
        if level == 1:
            segments = segments.select("grp", "lo", "hi", "anchor", "row", "start", "multi", "bytes").mapInArrow(
                _around_all(length, gram), "grp bigint, lo int, hi int, row bigint, multi boolean, anchor bigint, "
                                           "start bigint, bytes binary").withColumn("n", F.length("bytes"))
        segments = _halves(segments, length)
    total = small.agg(F.sum("n")).first()[0] or 0
    shards = int(max(1, -(-total // shard_bytes)))
    dealt = (small.withColumn("shard", F.pmod(F.xxhash64("grp"), F.lit(shards)).cast("int"))
             .repartition(shards, "shard").sortWithinPartitions("shard"))
    ranges = dealt.select("shard", "row", "start", "multi", "bytes").mapInArrow(
        _repeats(length), "row bigint, low bigint, high bigint")
    return covered.union(ranges)


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of texts with covered ranges."""
    for batch in batches:
        out = []
        for key, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("text_key", "text", "ranges")), strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            digest, removed, spans, at = hashlib.sha256(), 0, 0, 0
            end = -1
            for low, high in sorted((r["low"], r["high"]) for r in ranges):
                if low > end:
                    digest.update(raw[at:low])
                    spans += 1
                    end = low
                if high > end:
                    removed += high - end
                    end = at = high
            digest.update(raw[at:])
            out.append((key, removed, spans, digest.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                names=["text_key", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, **sizes) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes left."""
    raw = F.encode(body(), "UTF-8")
    named = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.md5(raw).alias("text_key"), F.octet_length(body()).cast("long").alias("n_bytes"),
        F.sha2(raw, 256).alias("whole_sha256"), body().alias("text"))
    signed = keep(named.mapInArrow(
        _anchor_rows(length, gram), "row bigint, doc_id bigint, text_key string, n_bytes bigint, whole_sha256 string, "
                                    "at array<int>, hash array<bigint>, again array<boolean>"), "sub-anchors")
    ranges = keep(covered_ranges(signed, documents, length, gram, **sizes)
                  .groupBy("row").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
                  .join(signed.select("row", "text_key"), "row").select("text_key", "ranges"), "sub-ranges")
    texts = documents.select(F.md5(raw).alias("text_key"), body().alias("text"))
    hit = checked_broadcast(ranges.select("text_key"), "text_key")
    stripped = keep(texts.join(hit, "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
                    .join(ranges, "text_key")
                    .mapInArrow(_strip, "text_key string, n_removed bigint, n_spans bigint, kept_sha256 string"), "sub-stripped")
    copies = (signed.filter(F.col("n_bytes") >= length).groupBy("text_key").agg(F.count(F.lit(1)).alias("copies"))
              .filter("copies > 1").select("text_key", F.lit(True).alias("copied")))
    gone = F.col("copied").isNotNull()
    empty = hashlib.sha256().hexdigest()
    return (signed.select("doc_id", "text_key", "n_bytes", "whole_sha256")
            .join(copies, "text_key", "left").join(stripped, "text_key", "left")
            .select("doc_id", "n_bytes",
                    F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                    F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
                    F.when(gone, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256")))

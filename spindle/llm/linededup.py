r"""Line dedup by pairwise alignment.

1. Equal texts are one class; only its first document (least doc_id, nulls last) is
   aligned.  A later copy is one aligned block and loses every line, provided its lines
   have ``min_chars`` characters together (line ends not counted).
2. Every run of lines with ``min_chars`` characters together that holds no shorter such
   run is a seed (often a line alone).  A seed that several classes hold leads each of them
   to its earliest holder, and so does every longer run of 2, 4, 8, ... lines: a shared
   block is covered by two such runs, whose earliest holders have them whole, wherever its
   single lines came first.  Seeds, and with them pairs, grow with the lines (times the
   logarithm of a text's lines), not with the square of a group.  One shared seed is
   enough, however many hold it, so what is lost does not depend on the corpus's size.
   (With the option ``rare``, off by default, a seed that more than ``rare`` classes hold
   needs a second one shared by the same pair.)
3. Overlapping pairs are aligned by patience diff over their lines, which are equal where
   their 64-bit hash and 60 bits of their SHA-256 agree, so lines whose seeds collide do
   not align: lines unique
   in both anchor the alignment along their longest increasing run, and the gaps between
   anchors are aligned the same way; a gap without such lines gets a longest common
   subsequence.  Aligned runs of equal lines with ``min_chars``
   characters together are common blocks, and the later document loses them.

An earliest holder keeps its line, so no line vanishes from the corpus.

Lines end at ``\n``.  Defined cases: null text counts as one empty line and stays null;
documents equal in id and text are copies of each other, the first written row comes
first; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import body, free_name, keep

MIN_CHARS = 24
TABLE_BITS = 1 << 28
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _longest_rise(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, given by rising first number, whose second numbers rise."""
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for n, (_, y) in enumerate(pairs):
        at = bisect_left(tails, y)
        before.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(y)
            ends.append(n)
        else:
            tails[at], ends[at] = y, n
    rise, n = [], ends[-1] if ends else -1
    while n >= 0:
        rise.append(pairs[n])
        n = before[n]
    return rise[::-1]


def _steps(a: Sequence[int], b: Sequence[int]) -> Iterator[int]:
    """For every prefix of ``a``: bit j is clear where b[j] lengthens the longest common subsequence."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = v = (1 << len(b)) - 1
    yield v
    for x in a:
        hit = v & where.get(x, 0)
        v = (v + hit | v - hit) & full
        yield v


def _lengths(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Lengths of the longest common subsequences of ``a`` and every prefix of ``b``."""
    for v in _steps(a, b):
        pass
    return [0, *accumulate(int(c == "0") for c in f"{v:0{len(b)}b}"[::-1])][:len(b) + 1]


def common_subsequence(a: Sequence[int], b: Sequence[int], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence of ``a[a0:a1]`` and ``b[b0:b1]``."""
    both = set(a[a0:a1]) & set(b[b0:b1])
    parts = [([i for i in range(a0, a1) if a[i] in both], [j for j in range(b0, b1) if b[j] in both])]
    matched = []
    while parts:
        left, right = parts.pop()
        x, y = [a[i] for i in left], [b[j] for j in right]
        if len(x) > 1 and len(x) * len(y) > TABLE_BITS:  # halved, so that the table stays small
            h = len(x) // 2
            head, tail = _lengths(x[:h], y), _lengths(x[h:][::-1], y[::-1])[::-1]
            cut = max(range(len(y) + 1), key=lambda j: head[j] + tail[j])
            parts += [(left[:h], right[:cut]), (left[h:], right[cut:])]
            continue
        steps, i, j = list(_steps(x, y)), len(x), len(y)
        while i and j:
            bit = 1 << j - 1
            if steps[i] & bit:
                j -= 1
            elif steps[i - 1] & bit:
                i, j = i - 1, j - 1
                matched.append((left[i], right[j]))
            else:
                i -= 1
    return matched


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Aligned positions of equal items of ``a`` and ``b``, both rising."""
    matched = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        anchors = _longest_rise([(i, where[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in where])
        if not anchors:
            matched += common_subsequence(a, b, a0, a1, b0, b1)
            continue
        i0, j0 = a0, b0
        for i, j in anchors:
            if i >= i0 and j >= j0:
                gaps.append((i0, i, j0, j))
                matched.append((i, j))
                i0, j0 = i + 1, j + 1
        gaps.append((i0, a1, j0, b1))
    return sorted(matched)


def common_blocks(later: Sequence[int], earlier: Sequence[int], chars: Sequence[int], least: int = 1) -> list[int]:
    """Lines of ``later`` in aligned blocks of ``least`` characters or more."""
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(later, earlier), (-1, -1)]:
        if (i, j) != (last[0] + 1, last[1] + 1) or i < 0:
            if sum(chars[x] for x in block) >= least:
                out += block
            block = []
        block.append(i)
        last = (i, j)
    return out


def run_hashes(lines: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of lines (``ends`` exclusive); a single line's is its own."""
    power = np.cumprod(np.full(len(lines), BASE))
    back = np.cumprod(np.full(len(lines), BASE_INVERSE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lines.view(np.uint64) * power)])
    return ((sums[ends] - sums[starts]) * back[starts]).view(np.int64)


def least_runs(chars: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``least`` characters or more that hold no shorter one."""
    sums = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    ends = np.maximum(np.searchsorted(sums, sums[:-1] + least), np.arange(1, len(sums)))
    starts = np.flatnonzero((ends < len(sums)) & (ends < np.append(ends[1:], len(sums))))
    return starts, ends[starts]


def least_seeds(lines: np.ndarray, chars: np.ndarray, least: int) -> np.ndarray:
    return np.unique(run_hashes(lines, *least_runs(chars, least)))


def longer_seeds(lines: np.ndarray, chars: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """Hashes of the runs of 2, 4, 8, ... lines that hold least runs, all of them in ``common``.

    Runs with a least run that no other text holds cannot be shared, and are left out.
    """
    firsts, lasts = least_runs(chars, least)
    alone = np.concatenate([[0], np.cumsum(~np.isin(run_hashes(lines, firsts, lasts), common))])
    found, width = [np.zeros(0, np.int64)], 2
    while width <= len(lines):
        starts = np.arange(len(lines) - width + 1)
        # the least runs inside are those from number a to number b (exclusive); their ends rise
        a, b = np.searchsorted(firsts, starts), np.searchsorted(lasts, starts + width, "right")
        starts = starts[(a < b) & (alone[np.maximum(a, b)] == alone[a])]
        if len(starts):
            found.append(run_hashes(lines, starts, starts + width))
        width *= 2
    return np.unique(np.concatenate(found))


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return (values[a:b] for a, b in zip(ends, ends[1:], strict=False))


def _as_lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))


def _seed(batches: Iterator[pa.RecordBatch], make: Callable[..., np.ndarray], names: Sequence[str], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [make(*row, least) for row in zip(*(_lists(batch.column(c)) for c in names), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("place"), _as_lists(found)], names=["row", "place", "seeds"])


def _seeds(texts: DataFrame, make: Callable[..., np.ndarray], least: int) -> DataFrame:
    """(row, place, seed) of the line lists of ``texts``."""
    names = [c for c in texts.columns if c not in ("row", "place")]
    place = texts.schema["place"].dataType.simpleString()
    return (texts.mapInArrow(partial(_seed, make=make, names=names, least=least), f"row bigint, place {place}, seeds array<bigint>")
            .select("row", "place", F.explode("seeds").alias("seed")))


def _numbered(names: dict[tuple[int, int], int], lines: Sequence[int], checks: Sequence[int]) -> list[int]:
    """A number for each line; lines have the same one if both of their hashes agree."""
    return [names.setdefault(x, len(names)) for x in zip(lines, checks, strict=True)]


def _align(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("later_lines", "later_checks", "earlier_lines", "earlier_checks", "later_chars"))
        lost = []
        for later, later_checks, earlier, earlier_checks, chars in zip(*columns, strict=True):
            names: dict[tuple[int, int], int] = {}
            lost.append(common_blocks(_numbered(names, later, later_checks), _numbered(names, earlier, earlier_checks), chars, least))
        yield pa.RecordBatch.from_arrays([batch.column("later"), pa.array(lost, pa.list_(pa.int32()))],
                                         names=["later", "lost"])


def _led(holds: DataFrame, name: str) -> DataFrame:
    """(row, seed, df, earlier, later): the shared seeds of (row, place, seed), with their earliest holder."""
    # written, so that the join below reads plain shuffles, whose hot seeds Spark can split
    shared = keep(holds.groupBy("seed").agg(F.count(F.lit(1)).alias("df"), F.min("place").alias("earliest"))
                  .filter("df > 1").select("seed", "df", F.col("earliest.row").alias("earlier")), f"{name}-shared")
    return keep(holds.select("row", "seed").join(shared, "seed").withColumn("later", F.col("row") != F.col("earlier")), f"{name}-led")


def lost_lines(documents: DataFrame, row: str, min_chars: int = MIN_CHARS, rare: int | None = None) -> DataFrame:
    """(row, doc_id, n_lines, lost): the numbers (from 0) of the lines that each document loses.

    ``row`` names a column of unique, stable row numbers.
    """
    lines = F.split(body(), "\n", -1)
    held = keep(documents.select(
        F.col(row).alias("row"), F.col("doc_id"), F.md5(F.encode(body(), "UTF-8")).alias("text_key"),
        F.transform(lines, lambda x: F.xxhash64(x)).alias("lines"),
        F.transform(lines, lambda x: F.conv(F.substring(F.sha2(x, 256), 1, 15), 16, 10).cast("long")).alias("checks"),
        F.transform(lines, lambda x: F.length(x)).alias("chars")), "lines")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    classes = held.groupBy("text_key").agg(F.min(order).alias("first"))
    firsts = keep(held.join(classes.select(F.col("first.row").alias("row")), "row", "left_semi")
                  .withColumn("place", order), "line-firsts")

    single = _led(_seeds(firsts.select("row", "place", "lines", "chars"), least_seeds, min_chars), "line")
    common = single.groupBy("row").agg(F.collect_set("seed").alias("common"))
    longer = _led(_seeds(firsts.join(common, "row").select("row", "place", "lines", "chars", "common"), longer_seeds, min_chars), "run")
    pairs = (single.unionByName(longer).filter("later").groupBy(F.col("row").alias("later"), "earlier")
             .agg(F.min("df").alias("df"), F.count(F.lit(1)).alias("n")))
    if rare is not None:
        pairs = pairs.filter((F.col("df") <= rare) | (F.col("n") > 1))
    # written as well: the earliest holder of a very common line is a hot key of the joins below
    pairs = keep(pairs.select("later", "earlier"), "line-pairs")
    sides = (pairs.join(firsts.select(F.col("row").alias("later"), F.col("lines").alias("later_lines"),
                                      F.col("checks").alias("later_checks"), F.col("chars").alias("later_chars")), "later")
             .join(firsts.select(F.col("row").alias("earlier"), F.col("lines").alias("earlier_lines"),
                                 F.col("checks").alias("earlier_checks")), "earlier"))
    lost = (sides.select("later", "later_lines", "later_checks", "earlier_lines", "earlier_checks", "later_chars")
            .mapInArrow(partial(_align, least=min_chars), "later bigint, lost array<int>")
            .groupBy(F.col("later").alias("row"))
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("lost")))).alias("lost")))
    n_lines = F.size("lines")
    whole = F.when(F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x) >= min_chars, F.sequence(F.lit(0), n_lines - 1))
    none = F.array().cast("array<int>")
    return (held.join(classes, "text_key").join(lost, "row", "left")
            .select("row", "doc_id", n_lines.cast("long").alias("n_lines"),
                    F.coalesce(F.when(F.col("row") != F.col("first.row"), whole).otherwise(F.col("lost")), none).alias("lost")))


def drop_lost_lines(documents: DataFrame, **options) -> DataFrame:
    """``documents``, all columns, with the lost lines taken out of ``text``.

    A row that loses every line is dropped: an earlier document holds all of it.
    ``n_chars``, where present, is the new text's length.
    """
    row, lost = free_name(documents, "_row"), free_name(documents, "_lost")
    rows = keep(documents.withColumn(row, F.monotonically_increasing_id()), "line-documents")
    found = (lost_lines(rows, row, **options).filter(F.size("lost") > 0)
             .select(F.col("row").alias(row), F.col("lost").alias(lost), F.col("n_lines").alias(lost + "n")))
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains(F.col(lost), i)), "\n")
    edited = (rows.join(found, row, "left").filter(F.col(lost).isNull() | (F.size(lost) < F.col(lost + "n")))
              .withColumn("text", F.when(F.col(lost).isNull(), F.col("text")).otherwise(kept)))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        edited = edited.withColumn("n_chars", F.when(F.col(lost).isNull(), F.col("n_chars"))
                                   .otherwise(F.length("text").cast(kind)))
    return edited.select(*(F.col(f"`{c}`") for c in documents.columns))


def document_losses(documents: DataFrame) -> DataFrame:
    """The lines that every document loses."""
    numbered = documents.withColumn("row", F.monotonically_increasing_id())
    return lost_lines(numbered, "row").drop("row")

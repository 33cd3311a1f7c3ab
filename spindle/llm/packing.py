"""Variable-capacity best-fit packing.

Documents are measured in UTF-8 bytes (or a given length column) and cut into pieces
no longer than the largest permitted sequence.  Pieces are dealt evenly over packing
tasks; each task packs its pieces by decreasing length:

* best fit: the open bin, of any size, with the least room that still holds the piece;
* otherwise a new bin of the permitted size with the least expected cost per packed
  unit.  Its expected content is found by filling it with the remaining pieces, longest
  first (what other open bins will take of them is not subtracted), and it costs the
  permitted size that such content is downsized to, plus a fixed overhead; ties go to the
  smaller size;
* at the end each bin is downsized to the least permitted size that holds its content.

Defined cases: null and empty texts are one piece of length 0 without a bin; pieces
of equal length are packed in doc_id order; repeated rows are packed one by one; an
empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import body

CAPACITIES = (2048, 4096, 8192, 16384)
BIN_OVERHEAD = 64
PIECES_PER_TASK = 50_000

PLACED = ("doc_id bigint, piece int, start bigint, length int, bin_id bigint, "
          "bin_offset int, bin_used int, bin_capacity int")


class Filler:
    """What the pieces from some position on put into a room, longest first."""

    def __init__(self, lengths: Sequence[int]):
        self.falling = [-x for x in lengths]
        self.sums = [0, *accumulate(lengths)]

    def content(self, room: int, at: int) -> int:
        """Each step takes a run of neighbouring pieces and halves the room at least, so steps are few."""
        filled = 0
        while (at := bisect_left(self.falling, filled - room, at)) < len(self.falling):
            end = bisect_right(self.sums, self.sums[at] + room - filled) - 1
            filled += self.sums[end] - self.sums[at]
            at = end
        return filled


def pack(lengths: Sequence[int], capacities: Sequence[int], overhead: int = BIN_OVERHEAD, by_lengths: bool = False
         ) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and the content of each bin.

    ``lengths`` descend and lie between 1 and the largest capacity.  ``rooms`` is a
    bit set of the rooms that open bins have, so the best fit is its lowest bit at or
    above the piece's length.  With ``by_lengths`` a new bin's expected content comes from
    the remaining lengths, without it from their sum alone.
    """
    capacities = sorted(capacities)
    open_bins: dict[int, list[int]] = defaultdict(list)
    rooms = 0
    bin_of, offset_of, used, capacity_of = [], [], [], []
    rest, least = sum(lengths), lengths[-1] if lengths else 0

    filler = Filler(lengths) if by_lengths else None

    def expected_cost(capacity: int, length: int, rest: int, after: int) -> float:
        if filler:
            content = length + filler.content(capacity - length, after)
            return (downsize(content, capacities) + overhead) / content
        content = length if capacity - length < least else min(capacity, length + rest)
        return (capacity + overhead) / content

    for n, length in enumerate(lengths):
        rest -= length
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room = min((c for c in capacities if c >= length), key=lambda c: (expected_cost(c, length, rest, n + 1), c))
            at = len(used)
            used.append(0)
            capacity_of.append(room)
        bin_of.append(at)
        offset_of.append(used[at])
        used[at] += length
        if room > length:
            open_bins[room - length].append(at)
            rooms |= 1 << (room - length)
    return bin_of, offset_of, used


def downsize(used: int, capacities: Sequence[int]) -> int:
    """The least permitted capacity that holds ``used``."""
    return min(c for c in capacities if c >= used)


def _packer(capacities: Sequence[int], overhead: int):
    names = ["doc_id", "piece", "start", "length", "bin_id", "bin_offset", "bin_used", "bin_capacity"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [row for b in batches for row in zip(*(b.column(c).to_pylist() for c in names[:4]), strict=True)]
        pieces.sort(key=lambda p: (-p[3], p[0] is not None, p[0], p[1]))
        full = [p for p in pieces if p[3]]
        bin_of, offset_of, used = pack([p[3] for p in full], capacities, overhead, by_lengths=True)
        first_id = TaskContext.get().partitionId() << 32
        rows = [(*p, first_id + b, o, used[b], downsize(used[b], capacities))
                for p, b, o in zip(full, bin_of, offset_of, strict=True)]
        rows += [(*p, None, None, None, None) for p in pieces if not p[3]]
        for at in range(0, len(rows), 10_000):
            part = zip(*rows[at:at + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, types, strict=True)], names=names)

    return run


def pack_documents(documents: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = BIN_OVERHEAD,
                   length: Column | None = None, pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """One row per piece with its bin, offset, and the bin's content and final capacity.

    The pieces are a narrow table (ids and lengths), dealt round-robin into tasks of
    about ``pieces_per_task``; texts do not move.
    """
    most = max(capacities)
    total = length if length is not None else F.octet_length(body())
    lengths = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                               F.coalesce(total, F.lit(0)).cast("long").alias("total"))
    last = F.greatest(F.ceil(F.col("total") / most) - 1, F.lit(0))
    pieces = (lengths.select("doc_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"))
              .select("doc_id", F.col("k").cast("int").alias("piece"), (F.col("k") * most).alias("start"),
                      F.least(F.lit(most), F.col("total") - F.col("k") * most).cast("int").alias("length")))
    n = lengths.agg(F.sum(last + 1)).first()[0] or 0
    tasks = max(1, -(-n // pieces_per_task))
    return pieces.repartition(int(tasks)).mapInArrow(_packer(tuple(capacities), overhead), PLACED)

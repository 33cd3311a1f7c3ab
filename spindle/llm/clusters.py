"""Links inside groups of possibly similar items, without pairing all items of a group.

``linked`` tests items of the same group for similarity and returns enough of the
similar pairs to connect everything that similar pairs connect:

1. every item is compared with its group's hub (the least id): linear work, and in a
   group of near-copies nearly all items pass;
2. items that do not match the hub are compared with all items of the group, in
   blocks of at most ``block`` by ``block`` in one task; a task returns only pairs that
   join parts not yet joined in it, fewer than its items.

Two items that both match the hub are connected through it and need no test.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Similar = Callable[[list, list], np.ndarray]


def agreeing_marks(share: float) -> Similar:
    """Equal-length byte strings that agree in at least ``share`` of their bytes."""

    def test(left: list, right: list) -> np.ndarray:
        a = np.frombuffer(b"".join(left), np.uint8).reshape(len(left), -1)
        b = np.frombuffer(b"".join(right), np.uint8).reshape(len(right), -1)
        same = np.zeros((len(a), len(b)), np.int32)
        for at in range(a.shape[1]):
            same += a[:, at][:, None] == b[:, at][None]
        return same >= share * a.shape[1]

    return test


def jaccard_sets(similarity: float, columns: int = 4096) -> Similar:
    """Sets of 64-bit elements with Jaccard similarity of at least ``similarity``."""

    def test(left: list, right: list) -> np.ndarray:
        sets = [*left, *right]
        size = np.array([len(s) for s in sets])
        values, at = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), size)
        in_left = owner < len(left)
        both = (np.bincount(at[in_left], minlength=len(values)) > 0) & (np.bincount(at[~in_left], minlength=len(values)) > 0)
        name = np.cumsum(both) - 1
        use = both[at]
        owner, at, in_left = owner[use], name[at[use]], in_left[use]
        shared = np.zeros((len(left), len(right)), np.float32)
        for low in range(0, int(both.sum()), columns):
            here = (at >= low) & (at < low + columns)
            a = np.zeros((len(left), columns), np.float32)
            b = np.zeros((len(right), columns), np.float32)
            a[owner[here & in_left], at[here & in_left] - low] = 1
            b[owner[here & ~in_left] - len(left), at[here & ~in_left] - low] = 1
            shared += a @ b.T
        total = size[:len(left), None] + size[None, len(left):]
        return shared >= similarity * (total - shared) - 1e-6

    return test


def spanning(similar: np.ndarray, left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Pairs of ``similar`` that connect whatever its pairs connect, fewer than there are items."""
    names = {x: n for n, x in enumerate(dict.fromkeys([*left, *right]))}
    part = np.arange(len(names))
    column = np.array([names[x] for x in right])
    links = []
    for row, item in enumerate(left):
        near = column[similar[row]]
        if not len(near):
            continue
        mine = names[item]
        parts, first = np.unique(part[near], return_index=True)
        new = parts != part[mine]
        if new.any():
            ids = np.flatnonzero(similar[row])[first[new]]
            links += [(item, right[i]) for i in ids]
            part[np.isin(part, parts[new])] = part[mine]
    return links


def sorted_units(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The sorted rows of each key, one table at a time."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(len(batch), bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        if waiting and any(waiting[0].column(k)[0].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(waiting)
            waiting = []
        edges = [0, *np.flatnonzero(change).tolist(), len(batch)]
        for low, high in zip(edges, edges[1:], strict=False):
            waiting.append(batch.slice(low, high - low))
            if high < len(batch):
                yield pa.Table.from_batches(waiting)
                waiting = []
    if waiting:
        yield pa.Table.from_batches(waiting)


def _payloads(column: pa.ChunkedArray) -> list:
    if pa.types.is_list(column.type):
        return [x.values.to_numpy(zero_copy_only=False) for chunk in column.chunks for x in chunk]
    return column.to_pylist()


def _search(test: Similar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for unit in sorted_units(batches, ["grp", "row_block", "all_block"]):
            asks = unit.column("asks").to_numpy()
            ids = unit.column("id").to_numpy()
            payload = _payloads(unit.column("payload"))
            left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
            if len(left) and len(right):
                similar = test([payload[i] for i in left], [payload[i] for i in right])
                similar &= ids[left][:, None] != ids[right][None]
                for x, y in spanning(similar, ids[left].tolist(), ids[right].tolist()):
                    a.append(x)
                    b.append(y)
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def linked(members: DataFrame, matches: DataFrame, test: Similar, payload: str, block: int = 512) -> DataFrame:
    """Links (a, b) that connect what similar pairs within a group connect.

    ``members``: (grp, id, payload), an id once per group.  ``matches``: (grp, id) of the
    items found similar to their group's hub, its least id.  Who meets whom is worked out
    on ids alone; payloads join the items of unsettled groups only.
    """
    ids = members.select("grp", "id")
    hubs = ids.groupBy("grp").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n"))
    matched = matches.groupBy("grp").agg(F.count(F.lit(1)).alias("ok"))
    sizes = (hubs.join(matched, "grp", "left").withColumn("open", F.col("n") - 1 - F.coalesce("ok", F.lit(0)))
             .filter("open > 0")
             .select("grp", "hub", F.ceil(F.col("n") / block).cast("int").alias("all_blocks"),
                     F.ceil(F.col("open") / block).cast("int").alias("row_blocks")))
    rows = ids.join(sizes, "grp").join(matches.select("grp", "id", F.lit(True).alias("ok")), ["grp", "id"], "left")
    place: dict[str, Column] = {n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int") for n in ("all_blocks", "row_blocks")}
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    unit = lambda row, every_row, asks: F.transform(
        every_row, lambda i: F.struct((row if asks else i).alias("row_block"), (i if asks else row).alias("all_block"),
                                      F.lit(asks).alias("asks")))
    asked = unit(place["all_blocks"], every("row_blocks"), False)
    asking = unit(place["row_blocks"], every("all_blocks"), True)
    asks = F.col("ok").isNull() & (F.col("id") != F.col("hub"))
    visits = rows.select("grp", "id", F.when(asks, F.concat(asked, asking)).otherwise(asked).alias("units"))
    found = (visits.join(members.select("grp", "id", F.col(payload).alias("payload")), ["grp", "id"])
             .select("grp", F.explode("units").alias("unit"), "id", "payload")
             .select("grp", "unit.row_block", "unit.all_block", "unit.asks", "id", "payload")
             .repartition("grp", "row_block", "all_block")
             .sortWithinPartitions("grp", "row_block", "all_block").mapInArrow(_search(test), "a bigint, b bigint"))
    to_hub = matches.join(hubs, "grp").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    return found.union(to_hub)

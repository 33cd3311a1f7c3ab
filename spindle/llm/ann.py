"""Approximate nearest neighbours by cosine with an inverted multi-index.

Index: unit vectors are cut into two halves, each quantised by its own codebook (k-means
on a bounded sample, about ``sample`` vectors by hash); the pair of codes is the vector's
cell.  Every vector is indexed.  Codebooks grow with the n indexed vectors: 8 n^(1/4)
centres each, 512 at most, which bounds the cells that the driver lays out.

Search: per query a heap walks centroid pairs by increasing summed distance until the
visited cells hold a share of the vectors (and 64 at least); all entries of those cells
are reranked by exact cosine in double precision.  The share falls as the codebooks get
finer: ``share`` = 0.5 at 2000 vectors, times (2000/n)^0.15, all below that size's 0.5
(``visited_share``; the README has the recall measured at each size).  There is no cap on
a cell: rows are laid out in blocks of about ``block_rows``, a crowded cell taking
several.  Queries go through in chunks of neighbours (ordered by cell, about
``query_rows`` each), and a block's rows go only to the chunks that visit it.

Ties: a block keeps every entry within rounding of a query's k-th score, scores them in
extended precision, so that vectors of one direction score the same, and passes on the
``k + 1`` first by score and least id.

Equal vectors are indexed once with their ``k + 1`` least ids, which are the only ones
of them that can be among anyone's ``k`` nearest, so a vector that a third of the rows
share costs one entry.

Defined cases: vectors that are null, zero, of another length than the most frequent
one, or hold null or non-finite components take no part, nor do rows without id;
rows repeated with the same id and vector count once, and no row with the query's id is
its neighbour; ties go to the smaller id; an empty table gives an empty result; extra
columns are dropped.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindle.llm.common import empty_frame, keep

CENTROIDS_MOST, SAMPLE, SHARE = 512, 20_000, 0.5
SHARE_AT, SHARE_POWER = 2000, 0.15
ROUNDING = 1e-12
BLOCK_ROWS, QUERY_ROWS = 4096, 2048
RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def kmeans(points: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Lloyd's algorithm on a small in-memory sample; at most one centre per distinct point."""
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    centres = points[rng.permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        nearest = np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        n = np.bincount(nearest, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def runs_of_cells(counts: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First run of each cell and its number of runs, for runs of about ``rows`` members in the order of cells."""
    splits = np.maximum(1, -(-counts // rows))
    first = np.zeros(len(counts), np.int64)
    run, filled = 0, 0
    for cell, n in enumerate(counts):
        if filled and filled + n > rows:
            run, filled = run + 1, 0
        first[cell] = run
        filled += n
        if splits[cell] > 1:
            run, filled = run + splits[cell], 0
    return first, splits


@dataclass
class MultiIndex:
    """Both codebooks, the vectors per cell and the blocks that hold each cell."""

    halves: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray | None = None
    first_block: np.ndarray | None = None
    splits: np.ndarray | None = None

    def distances(self, unit: np.ndarray) -> list[np.ndarray]:
        cut = self.halves[0].shape[1]
        return [((part**2).sum(1)[:, None] - 2 * part @ c.T + (c**2).sum(1)[None])
                for part, c in zip((unit[:, :cut], unit[:, cut:]), self.halves, strict=True)]

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a, b = (np.argmin(d, axis=1) for d in self.distances(unit))
        return a * len(self.halves[1]) + b

    def lay_out(self, counts: np.ndarray, block_rows: int) -> None:
        """Give runs of cells to blocks; a cell larger than a block gets several of its own."""
        self.counts = counts
        self.first_block, self.splits = runs_of_cells(counts, block_rows)

    def walk(self, near: np.ndarray, far: np.ndarray, wanted: int) -> list[int]:
        """Cells by increasing summed distance of their two centres until they hold ``wanted`` vectors."""
        a, b = np.argsort(near, kind="stable"), np.argsort(far, kind="stable")
        x, y, width = near[a].tolist(), far[b].tolist(), len(b)
        heap, row_of, cells, held = [(x[0] + y[0], 0, 0)], [0] * len(x), [], 0
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            cell = int(a[i]) * width + int(b[j])
            if n := int(self.counts[cell]):
                cells.append(cell)
                held += n
            if j == 0 and i + 1 < len(x):
                heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
            if j + 1 < width:
                heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        return cells


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _assign(index: MultiIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cells = index.cells(_unit(_matrix(batch.column("vector"))))
                yield batch.append_column("cell", pa.array(cells, pa.int32()))

    return run


def _visit(index: MultiIndex, wanted: int):
    """Each query once per block that it visits, with the cells to look at there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            near, far = index.distances(_unit(_matrix(batch.column("vector"))))
            at, blocks, cells_of = [], [], []
            for q in range(len(batch)):
                cells = np.array(index.walk(near[q], far[q], wanted), np.int32)
                for split in range(int(index.splits[cells].max())):
                    here = cells[index.splits[cells] > split]
                    block = index.first_block[here] + split
                    order = np.argsort(block, kind="stable")
                    edges = np.flatnonzero(np.diff(block[order], prepend=-1))
                    for low, high in zip(edges, [*edges[1:], len(order)], strict=True):
                        at.append(q)
                        blocks.append(int(block[order[low]]))
                        cells_of.append(here[order[low:high]])
            for low in range(0, len(at), 2000):
                part = slice(low, low + 2000)
                rows = batch.take(pa.array(at[part]))
                yield rows.append_column("block", pa.array(blocks[part], pa.int32())).append_column(
                    "cells", pa.array(cells_of[part], pa.list_(pa.int32())))

    return run


def codebook_size(n: int) -> int:
    return max(1, min(CENTROIDS_MOST, int(np.ceil(8 * n**0.25))))


def visited_share(n: int, share: float = SHARE) -> float:
    """The share of ``n`` indexed vectors that a query visits."""
    return min(1.0, share * (SHARE_AT / max(n, 1)) ** SHARE_POWER)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosines, computed in extended precision and rounded once to doubles."""
    a, b = a.astype(np.longdouble), b.astype(np.longdouble)
    return ((a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))).astype(np.float64)


def _rerank(keep_n: int):
    """The ``keep_n`` first classes of a block for each visiting query, by score and least id."""

    def run(entries: pd.DataFrame, visits: pd.DataFrame) -> pd.DataFrame:
        if not len(entries) or not len(visits):
            return pd.DataFrame({"query_class": [], "score": [], "class_id": []})
        entries = entries.sort_values(["cell", "class_id"], ignore_index=True)
        x = np.stack(entries["vector"].to_numpy()).astype(np.float64)
        visits = visits.groupby("class_id", sort=True).agg({"vector": "first", "cells": lambda c: np.concatenate(list(c))})
        q = np.stack(visits["vector"].to_numpy()).astype(np.float64)
        unit_x, unit_q = _unit(x), _unit(q)
        visitors: dict[int, list[int]] = {}
        for i, cells in enumerate(visits["cells"]):
            for cell in cells:
                visitors.setdefault(int(cell), []).append(i)
        scores = np.full((len(q), len(x)), -np.inf)
        cell_of = entries["cell"].to_numpy()
        edges = np.flatnonzero(np.diff(cell_of, prepend=-1))
        for low, high in zip(edges, [*edges[1:], len(x)], strict=True):
            if who := visitors.get(int(cell_of[low])):
                scores[who, low:high] = unit_q[who] @ unit_x[low:high].T
        n = min(keep_n, len(x))
        least = -np.partition(-scores, n - 1, axis=1)[:, n - 1:n]
        row, best = np.nonzero(np.isfinite(scores) & (scores >= least - ROUNDING))
        exact = np.concatenate([cosine(q[row[i:i + 8192]], x[best[i:i + 8192]]) for i in range(0, len(row), 8192)]
                               or [np.zeros(0)])
        order = np.lexsort((entries["least"].to_numpy()[best], -exact, row))
        row, best, exact = row[order], best[order], exact[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < n
        return pd.DataFrame({"query_class": visits.index.to_numpy()[row[first]], "score": exact[first],
                             "class_id": entries["class_id"].to_numpy()[best[first]]})

    return run


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def _cell_counts(rows: DataFrame, n_cells: int) -> np.ndarray:
    counts = np.zeros(n_cells, np.int64)
    for r in rows.groupBy("cell").count().collect():  # at most a row per cell
        counts[r["cell"]] = r["count"]
    return counts


def _places(spark: SparkSession, counts: np.ndarray, runs: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    return spark.createDataFrame([(c, int(runs[0][c]), int(runs[1][c])) for c in np.flatnonzero(counts).tolist()],
                                 "cell int, first int, splits int")


def _in_run(rows: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """``rows`` with the number of their cell's run; ``places`` has at most a row per cell."""
    run = F.col("first") + F.pmod(F.xxhash64("class_id"), F.col("splits"))
    return rows.join(F.broadcast(places), "cell").withColumn(name, run.cast("int")).drop("first", "splits")


def nearest(embeddings: DataFrame, is_query: Column, k: int = 5, centroids: int | None = None, share: float = SHARE,
            sample: int = SAMPLE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` nearest found of each row where ``is_query`` holds, of (vec_id, embedding)."""
    spark = embeddings.sparkSession
    kind = embeddings.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("vector"),
                              F.coalesce(is_query, F.lit(False)).alias("asks"))
            .filter(F.col("vec_id").isNotNull() & _usable(F.col("vector"))))
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return empty_frame(spark, RESULT)
    rows = rows.filter(F.size("vector") == common["d"]).distinct()
    least = Window.partitionBy("vector").orderBy("vec_id")
    classes = keep(rows.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k + 1)
                   .groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
                   .withColumn("class_id", F.monotonically_increasing_id()), "ann-classes")
    asking = keep(rows.filter("asks").select("vec_id", "vector")
                  .join(classes.select("class_id", "vector"), "vector").select("vec_id", "class_id"), "ann-queries")

    n_classes = classes.count()
    drawn = (classes.filter(F.pmod(F.xxhash64("vector"), F.lit(max(1, n_classes // sample))) == 0)
             .select("vector").limit(sample).collect()) or classes.select("vector").limit(sample).collect()
    points = _unit(np.array([r["vector"] for r in drawn], np.float64))
    cut = max(1, points.shape[1] // 2)
    second = points[:, cut:] if points.shape[1] > 1 else np.zeros((len(points), 0))
    centroids = centroids or codebook_size(n_classes)
    index = MultiIndex((kmeans(points[:, :cut], centroids), kmeans(second, centroids)))
    entries = keep(classes.select("class_id", "vector", F.col("members")[0].alias("least")).mapInArrow(
        _assign(index), f"class_id bigint, vector {kind}, least bigint, cell int"), "ann-entries")
    askers = entries.join(asking.select("class_id").distinct(), "class_id", "left_semi").select("class_id", "vector", "cell")
    n_cells = len(index.halves[0]) * len(index.halves[1])
    index.lay_out(_cell_counts(entries, n_cells), block_rows)
    places = _places(spark, index.counts, (index.first_block, index.splits))
    asked = _cell_counts(askers, n_cells)
    deal = _places(spark, asked, runs_of_cells(asked, query_rows))
    wanted = max(64, int(np.ceil(visited_share(n_classes, share) * n_classes)))
    visits = keep(_in_run(askers, deal, "chunk").drop("cell")
                  .mapInArrow(_visit(index, wanted), f"class_id bigint, vector {kind}, chunk int, block int, cells array<int>"),
                  "ann-visits")
    blocks = (_in_run(entries, places, "block")
              .join(visits.select(F.col("block").alias("block"), F.col("chunk").alias("chunk")).distinct(), "block")
              .select("class_id", "vector", "least", "cell", "block", "chunk"))
    found = (blocks.groupBy("block", "chunk").cogroup(visits.groupBy("block", "chunk"))
             .applyInPandas(_rerank(k + 1), "query_class bigint, score double, class_id bigint"))
    near = Window.partitionBy("query_class").orderBy(F.desc("score"), "vec_id")
    members = (found.join(classes.select("class_id", "members"), "class_id")
               .select("query_class", "score", F.explode("members").alias("vec_id"))
               .withColumn("at", F.row_number().over(near)).filter(F.col("at") <= k + 1))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (members.join(asking.select(F.col("vec_id").alias("query_id"), F.col("class_id").alias("query_class")),
                         "query_class")
            .filter(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

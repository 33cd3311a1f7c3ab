"""Centroid clustering in integers, with PCA-rotated filtering.

Every kept vector becomes a point of integers, ``floor(scale * x)`` per component.  Its
coordinates along the leading principal axes and the norm of the rest are stored beside
it.  For a point v and a centroid c with leading coordinates p and residual norms r

    |p(v) - p(c)|^2 + (r(v) - r(c))^2  <=  |v - c|^2,

whatever the rotation, so centroids whose bound (less a margin for rounding) exceeds a
known distance are filtered, and the survivors are verified with exact integers.  The
axes come from a bounded sample of at most ``sample`` vectors (by hash of the id); they
decide how much is filtered, never the result.  Assignments go to the nearest centroid, ties to the
smaller number; an update takes the floor of the exact mean, and a centroid without
points stays.  Tasks send one sum per centroid and component, so a round shuffles
``k * dim`` rows a task and the driver gets ``k * dim``.

Defined cases: vectors that are null, of another length than ``dim``, or hold null or
non-finite components are not kept; repeated rows are points of their own; a null id is
hashed as an empty one; with fewer kept vectors than ``k`` there are as many centroids
as vectors; no kept vector, empty result; distances and sums beyond 2^63 - 1 are
computed exactly and returned as 2^63 - 1; extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import empty_frame, keep

K, DIM, ROUNDS, SCALE, SEED = 8, 64, 10, 1024, 3
LEAD, SAMPLE = 16, 20_000
MARGIN = 1e-9  # of the squared sizes involved; rounding stays below 1e-12 of them
MOST = 2**63 - 1
LIMB = 2**60  # sums travel as two limbs, each within a decimal(38, 0)

POINTS = "vec_id bigint, point array<double>, lead array<double>, rest double"
RESULT = ("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
          "centroid_sha256 string")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _lists(x: np.ndarray) -> pa.Array:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel(), pa.float64()))


@dataclass(frozen=True)
class Rotation:
    """Principal axes around a centre; the first ``lead`` coordinates are kept, the rest as a norm."""

    centre: np.ndarray
    axes: np.ndarray
    lead: int

    @staticmethod
    def fit(points: np.ndarray, lead: int) -> Rotation:
        centre = points.mean(axis=0)
        spread = points - centre
        size = max(float(np.abs(spread).max()), 1.0)
        _, vectors = np.linalg.eigh((spread / size).T @ (spread / size))
        return Rotation(centre, vectors[:, ::-1].copy(), min(lead, points.shape[1]))

    def turn(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = (points - self.centre) @ self.axes
        return turned[:, :self.lead], np.sqrt((turned[:, self.lead:] ** 2).sum(axis=1))


def _whole(points: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as exact integers: 64 bits where no squared distance can overflow, else Python's."""
    size = max((float(np.abs(x).max()) for x in (points, others) if x.size), default=0.0)
    if points.shape[1] * (2 * size) ** 2 < 2.0**62:
        return points.astype(np.int64), others.astype(np.int64)
    as_ints = np.vectorize(int, otypes=[object])
    return as_ints(points), as_ints(others)


class Filter:
    """The centroids of a round, rotated once, and the filtered assignment to them."""

    def __init__(self, centroids: np.ndarray, rotation: Rotation):
        self.centroids = centroids
        self.lead, self.rest = rotation.turn(centroids.astype(np.float64))
        self.base = float((rotation.centre**2).sum())

    def bounds(self, lead: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances, row by centroid."""
        own, theirs = (lead**2).sum(axis=1)[:, None], (self.lead**2).sum(axis=1)[None]
        distance = own + theirs - 2 * lead @ self.lead.T + (rest[:, None] - self.rest[None]) ** 2
        size = own + theirs + rest[:, None] ** 2 + self.rest[None] ** 2 + self.base
        return distance - MARGIN * size

    def assign(self, points: np.ndarray, lead: np.ndarray, rest: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Nearest centroid and exact squared distance of each point, the points as integers, distances verified."""
        whole, centres = _whole(points, self.centroids)
        low = self.bounds(lead, rest)
        label = np.argmin(low, axis=1)
        best = ((whole - centres[label]) ** 2).sum(axis=1)
        verified = len(points)
        open_ = low <= best.astype(np.float64)[:, None] * (1 + MARGIN)
        open_[np.arange(len(points)), label] = False
        for c in range(len(centres)):
            at = np.flatnonzero(open_[:, c])
            if len(at):
                exact = ((whole[at] - centres[c]) ** 2).sum(axis=1)
                wins = (exact < best[at]) | ((exact == best[at]) & (c < label[at]))
                label[at[wins]], best[at[wins]] = c, exact[wins.astype(bool)]
                verified += len(at)
        return label, best, whole, verified


def _pointer(scale: int, dim: int, rotation: Rotation):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.floor(scale * _matrix(batch.column("vector"), dim))
            lead, rest = rotation.turn(points)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _lists(points), _lists(lead), pa.array(rest)],
                                             names=["vec_id", "point", "lead", "rest"])

    return run


def _sums(near: Filter):
    """One row per centroid and component of a task: points, and their sum in two limbs."""
    k, dim = near.centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(k, np.int64), np.zeros((k, dim), object)
        for batch in batches:
            points = _matrix(batch.column("point"), dim)
            label, _, whole, _ = near.assign(points, _matrix(batch.column("lead"), near.lead.shape[1]),
                                             batch.column("rest").to_numpy(zero_copy_only=False))
            counts += np.bincount(label, minlength=k)
            for c in np.unique(label):
                totals[c] += whole[label == c].sum(axis=0).astype(object)  # components below 2^31 unless of object type
        here = np.flatnonzero(counts)
        limbs = [divmod(int(t), LIMB) for c in here for t in totals[c]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(here, dim), pa.int32()), pa.array(np.tile(np.arange(dim), len(here)), pa.int32()),
             pa.array(np.repeat(counts[here], dim), pa.int64()),
             *(pa.array([Decimal(x[i]) for x in limbs], pa.decimal128(38, 0)) for i in (0, 1))],
            names=["cluster", "component", "n", "high", "low"])

    return run


def _labels(near: Filter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, best, _, _ = near.assign(_matrix(batch.column("point"), near.centroids.shape[1]),
                                            _matrix(batch.column("lead"), near.lead.shape[1]),
                                            batch.column("rest").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(label, pa.int32()),
                 pa.array([min(int(d), MOST) for d in best], pa.int64())], names=["vec_id", "cluster", "distance"])

    return run


def _kept(vector: Column, dim: int) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) == dim) & fine, F.lit(False))


def _start(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` points with the least SHA-256 of ``<seed>:<id>``."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.orderBy(key, "point").limit(k).select("point").collect()
    return np.array([r["point"] for r in rows], np.float64)


def _updated(points: DataFrame, near: Filter) -> np.ndarray:
    sums = (points.mapInArrow(_sums(near), "cluster int, component int, n bigint, high decimal(38,0), low decimal(38,0)")
            .groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum("high").alias("high"),
                                                 F.sum("low").alias("low")).collect())  # k * dim rows
    new = near.centroids.copy()
    for r in sums:
        new[r["cluster"], r["component"]] = (int(r["high"]) * LIMB + int(r["low"])) // r["n"]
    return new


def cluster_vectors(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
                    seed: int = SEED, lead: int = LEAD, sample: int = SAMPLE) -> DataFrame:
    """Cluster, squared distance, inertias and the centroid's digest for every kept row of (vec_id, embedding).

    Centroids hold Python integers, so nothing is rounded; a round that changes none of
    them ends the rounds, as later ones would repeat it.
    """
    spark = embeddings.sparkSession
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                              F.col("embedding").cast("array<double>").alias("vector"))
            .filter(_kept(F.col("vector"), dim)))
    buckets = max(1, embeddings.count() // sample)
    drawn = (rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(buckets)) == 0).select("vector").limit(sample).collect()
             or rows.select("vector").limit(sample).collect())
    if not drawn:
        return empty_frame(spark, RESULT)
    rotation = Rotation.fit(np.floor(scale * np.array([r["vector"] for r in drawn])), lead)
    points = keep(rows.mapInArrow(_pointer(scale, dim, rotation), POINTS), "centroid-points")
    centroids = np.vectorize(int, otypes=[object])(_start(points, k, seed))
    for _ in range(rounds):
        new = _updated(points, Filter(centroids, rotation))
        if (new == centroids).all():
            break
        centroids = new
    assigned = keep(points.mapInArrow(_labels(Filter(centroids, rotation)), "vec_id bigint, cluster int, distance bigint"),
                    "centroid-clusters")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(total.alias("d")).collect()}  # k rows
    digests = spark.createDataFrame(
        [(c, min(d, MOST), min(sum(inertia.values()), MOST),
          sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, d in sorted(inertia.items())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return (assigned.join(F.broadcast(digests), "cluster")  # k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))

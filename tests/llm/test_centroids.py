"""Centroid clustering: brute force in Python integers, sound bounds, unusable vectors."""

from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindle.llm import centroids, queries


def brute(rows, k=8, rounds=10, scale=1024, seed=3):
    """``rows`` of (id, vector): Lloyd's rounds on Python integers."""
    points = [[int(np.floor(scale * float(x))) for x in v] for _, v in rows]
    key = [sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest() for i, _ in rows]
    middle = [points[r] for r in sorted(range(len(rows)), key=lambda r: (key[r], points[r]))[:k]]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), j)
                          for j, c in enumerate(middle)) for p in points]
    for _ in range(rounds):
        label = [j for _, j in assign()]
        for j in range(len(middle)):
            if own := [p for p, at in zip(points, label, strict=True) if at == j]:
                middle[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    found = assign()
    most = 2**63 - 1
    own = [sum(d for d, j in found if j == c) for c in range(len(middle))]
    return sorted(((i, j, min(d, most), min(own[j], most), min(sum(own), most), digest[j])
                   for (i, _), (d, j) in zip(rows, found, strict=True)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")


def test_the_table_against_brute_force(spark):
    from conftest import SF
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert result(queries.op13_centroid_clustering(spark, SF)) == brute(rows)


def test_clusters_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 4))
    rows = [(i % 150, [float(np.float32(x)) for x in centres[i % 5] + 0.05 * rng.normal(size=4)]) for i in range(200)]
    rows += [(500 + i, [0.5, -0.25, 1.0, 0.0]) for i in range(60)] + [(7, [1.0, 1.0, 1.0, 1.0])] * 3
    got = result(centroids.cluster_vectors(table(spark, rows), k=6, rounds=4, dim=4, lead=2))
    assert got == brute(rows, k=6, rounds=4)


def test_a_constant_table_and_few_vectors(spark):
    same = [(i, [0.5, 0.5]) for i in range(9)]
    assert result(centroids.cluster_vectors(table(spark, same), k=3, dim=2)) == brute(same, k=3)
    few = [(3, [0.5, -0.5]), (4, [0.25, 1.0])]
    got = result(centroids.cluster_vectors(table(spark, few), dim=2))
    assert got == brute(few, k=2) and [r[2] for r in got] == [0, 0]


def test_large_components_stay_exact(spark):
    big = [(1, [3e38, -1.0]), (2, [2.9e38, 4.0]), (3, [1e20, 5e19]), (4, [0.5, 0.25]), (5, [3e30, 3.0]), (6, [0.75, 2.0])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in big]
    assert result(centroids.cluster_vectors(table(spark, rows), k=3, rounds=5, dim=2)) == brute(rows, k=3, rounds=5)


def test_unusable_vectors_are_left_out(spark):
    good = [(1, [0.5, 1.5]), (None, [0.25, 1.0]), (2, [-1.0, 0.0])]
    bad = [(10, None), (11, []), (12, [1.0]), (13, [1.0, 2.0, 3.0]), (14, [None, 1.0]), (15, [float("nan"), 1.0]),
           (16, [float("inf"), 0.0])]
    rows = table(spark, good + bad).withColumn("cluster", F.lit("x")).withColumn("point", F.lit(1))
    assert result(centroids.cluster_vectors(rows, k=2, dim=2)) == brute(good, k=2)
    none = centroids.cluster_vectors(table(spark, bad), dim=2)
    assert none.count() == 0 and none.columns == rows_columns()


def rows_columns():
    return ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("lead", [1, 3, 8])
def test_bounds_are_below_the_distances_and_filter(lead):
    rng = np.random.default_rng(2)
    middle = np.floor(1024 * rng.normal(size=(6, 8)))
    points = middle[rng.integers(0, 6, 400)] + np.floor(60 * rng.normal(size=(400, 8)))
    rotation = centroids.Rotation.fit(points, lead)
    near = centroids.Filter(np.vectorize(int, otypes=[object])(middle), rotation)
    exact = ((points[:, None] - middle[None]) ** 2).sum(axis=2)
    assert (near.bounds(*rotation.turn(points)) <= exact).all()
    label, best, _, verified = near.assign(points, *rotation.turn(points))
    assert (label == exact.argmin(axis=1)).all() and (best.astype(float) == exact.min(axis=1)).all()
    assert verified < 0.6 * exact.size

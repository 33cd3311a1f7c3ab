"""Inverted multi-index: recall against brute force, ties, unusable vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindle.llm import ann, queries


def brute(ids, vectors, queries_, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for q in queries_:
        at = ids.index(q)
        score = unit @ unit[at]
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-round(score[i], 12), ids[i]))[:k]
        out[q] = [(ids[i], score[i]) for i in order]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.get(r.query_id, [])) + 1
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_on_the_table(spark):
    from conftest import SF
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    truth = brute(ids, vectors, [i for i in ids if i % 50 == 0], 5)
    got = answers(queries.op3_multi_index_search(spark, SF))
    assert set(got) == set(truth)
    hits = sum(score >= truth[q][-1][1] - 1e-12 for q, found in got.items() for _, score in found)
    assert hits >= 0.9 * 5 * len(truth)
    exact = {(q, v): s for q, found in brute(ids, vectors, list(truth), len(ids)).items() for v, s in found}
    assert all(s == pytest.approx(exact[q, v], abs=1e-12) for q, found in got.items() for v, s in found)


def test_walk_visits_cells_by_summed_distance():
    index = ann.MultiIndex((np.zeros((3, 1)), np.zeros((3, 1))))
    index.counts = np.ones(9, np.int64)
    near, far = np.array([0.0, 1.0, 5.0]), np.array([0.5, 0.0, 9.0])
    cells = index.walk(near, far, 9)
    cost = [near[c // 3] + far[c % 3] for c in cells]
    assert cost == sorted(cost) and sorted(cells) == list(range(9))
    index.counts[cells[0]] = 0
    assert index.walk(near, far, 2) == cells[1:3]


def test_crowded_cells_get_blocks_of_their_own():
    index = ann.MultiIndex((np.zeros((2, 1)), np.zeros((2, 1))))
    index.lay_out(np.array([3, 25, 4, 2]), 10)
    taken = [range(f, f + s) for f, s in zip(index.first_block, index.splits, strict=True)]
    assert [len(t) for t in taken] == [1, 3, 1, 1]
    assert not set(taken[1]) & set(taken[2])


def test_many_blocks_and_chunks_give_the_same_answers(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 6)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ask = F.col("vec_id") % 3 == 0
    one = answers(ann.nearest(df, ask, centroids=4, share=1.0))
    split = answers(ann.nearest(df, ask, centroids=4, share=1.0, block_rows=7, query_rows=9))
    assert one == split
    vectors = np.array([r[1] for r in rows], np.float32).astype(float)
    truth = brute(list(range(300)), vectors, range(0, 300, 3), 5)
    assert {q: [v for v, _ in f] for q, f in one.items()} == {q: [v for v, _ in f] for q, f in truth.items()}


def test_copies_ties_and_unusable_vectors(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(i, a) for i in range(20)] + [(100, b), (100, b), (101, [0.0, 0.0, 0.0]), (102, None), (103, [1.0, None, 0.0]),
            (104, [float("nan"), 0.0, 1.0]), (105, [float("inf"), 0.0, 1.0]), (106, [1.0, 2.0]), (None, a), (50, [2.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<float>, score int")
    got = answers(ann.nearest(df, F.col("vec_id") % 50 == 0, k=5))
    assert got == {0: [(v, 1.0) for v in (1, 2, 3, 4, 5)], 50: [(v, 1.0) for v in (0, 1, 2, 3, 4)],
                   100: [(v, 0.0) for v in (0, 1, 2, 3, 4)]}
    few = spark.createDataFrame([(0, a), (1, b)], "vec_id long, embedding array<float>")
    assert answers(ann.nearest(few, F.col("vec_id") == 0)) == {0: [(1, 0.0)]}
    single = spark.createDataFrame([(0, a)], "vec_id long, embedding array<float>")
    assert answers(ann.nearest(single, F.col("vec_id") == 0)) == {}
    assert answers(ann.nearest(few.limit(0), F.col("vec_id") == 0)) == {}
    line = spark.createDataFrame([(0, [1.0]), (1, [-2.0]), (2, [3.0])], "vec_id long, embedding array<float>")
    assert answers(ann.nearest(line, F.col("vec_id") == 0)) == {0: [(2, 1.0), (1, -1.0)]}


def test_many_different_vectors_of_one_cosine_go_by_id(spark):
    rng = np.random.default_rng(4)
    query, other = rng.normal(size=8), rng.normal(size=8)
    rows = [(950, query)] + [(960 + i, (1 + 0.37 * i) * other) for i in range(40)] + [(1 + i, -query + 0.1 * rng.normal(size=8)) for i in range(30)]
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "vec_id bigint, embedding array<double>")
    got = answers(ann.nearest(table, F.col("vec_id") == 950, k=5, block_rows=16))
    best = np.argsort(-np.array([query @ other / np.linalg.norm(query) / np.linalg.norm(other)] * 40))
    assert len(best) == 40 and [v for v, _ in got[950]] == [960, 961, 962, 963, 964]


def test_chunks_and_blocks_change_nothing(spark):
    from conftest import SF
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    whole = answers(ann.nearest(rows, F.col("vec_id") % 3 == 0, k=4))
    small = answers(ann.nearest(rows, F.col("vec_id") % 3 == 0, k=4, block_rows=32, query_rows=10))
    assert whole == small


def test_codebooks_grow_and_the_visited_share_falls():
    sizes = [ann.codebook_size(n) for n in (1, 16, 2000, 50_000, 10**6, 10**12)]
    assert sizes == sorted(sizes) and sizes[-1] == ann.CENTROIDS_MOST
    shares = [ann.visited_share(n) for n in (1, 500, 2000, 50_000, 10**9)]
    assert shares == sorted(shares, reverse=True) and shares[0] == 1.0 and shares[2] == ann.SHARE

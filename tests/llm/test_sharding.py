"""Uniform shuffle into exact shards."""

import math
import zlib
from collections import Counter

import numpy as np

from spindle.llm import queries, sharding


def test_hypergeometric_has_the_right_law():
    rng = np.random.default_rng(5)
    good, bad, draws, n = 7, 12, 9, 20_000
    seen = Counter(sharding.hypergeometric(rng, good, bad, draws) for _ in range(n))
    for k in range(0, 8):
        p = math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
        assert abs(seen[k] - n * p) < 5 * math.sqrt(n * p) + 1
    big = [sharding.hypergeometric(rng, 4 * 10**11, 6 * 10**11, 10**9) for _ in range(50)]
    assert abs(np.mean(big) / 4e8 - 1) < 1e-4
    assert sharding.hypergeometric(rng, 0, 5, 3) == 0 and sharding.hypergeometric(rng, 5, 0, 3) == 3


def test_matrix_margins_are_exact():
    counts = [0, 5, 100, 1, 37]
    sizes = sharding.shard_sizes(sum(counts), 7)
    matrix = sharding.communication_matrix(counts, sizes, 3)
    assert [sum(r) for r in matrix] == counts and [sum(c) for c in zip(*matrix, strict=True)] == sizes


def placed(df, n, **kw):
    rows = sharding.shuffle_into_shards(df, n, **kw).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(n)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    return rows


def test_shards_are_exact_and_mixed(spark):
    df = spark.range(0, 5000, 1, 9).withColumnRenamed("id", "doc_id")
    rows = placed(df, 24, rows_per_bucket=50)
    assert sorted(r.doc_id for r in rows) == list(range(5000))
    again = placed(df, 24, rows_per_bucket=50)
    assert {tuple(r) for r in rows} == {tuple(r) for r in again}
    assert {tuple(r) for r in rows} != {tuple(r) for r in placed(df, 24, seed=8)}
    first = [r.doc_id for r in rows if r.shard == 0]
    assert 1800 < np.mean(first) < 3200 and len({r.doc_id // 1000 for r in rows if r.slot == 0}) > 2


def test_edge_cases(spark):
    rows = [(1, None, 5), (1, None, 5), (None, "", 6), (3, "é", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int").selectExpr("*", "0 as _part", "1 as _pos", "2 as _rank")
    got = placed(df, 3)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r._part) for r in got) == \
        [(False, 1, "", 0), (False, 1, "", 0), (False, 3, "é", 0), (True, 0, "", 0)]
    empty = sharding.shuffle_into_shards(df.limit(0), 3)
    assert empty.collect() == [] and empty.columns[-2:] == ["shard", "slot"]
    docs = {r.doc_id: r for r in sharding.document_shards(df).collect()}
    assert (docs[3].size, docs[3].text_crc32) == (10, zlib.crc32("é".encode()))
    assert (docs[1].size, docs[1].text_crc32, docs[1].law, docs[1].grown_shard) == (8, 0, "rows", None)


def test_query_over_the_table(spark):
    from conftest import SF
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op7_sharding(spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == \
        {d: (len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in texts.items()}
    assert len(rows) == len(texts)


def test_the_local_permutation_is_one_and_mixes():
    for n in (1, 2, 3, 100, 1025, 20_000):
        out = sharding.permuted(np.arange(n), n, 11)
        assert sorted(out.tolist()) == list(range(n))
    image = sharding.permuted(np.arange(20_000), 20_000, 11)
    assert abs(np.corrcoef(np.arange(20_000), image)[0, 1]) < 0.03
    assert abs(np.corrcoef(image[:-1], image[1:])[0, 1]) < 0.03
    assert (image != sharding.permuted(np.arange(20_000), 20_000, 12)).mean() > 0.99


def test_two_level_draws_keep_the_margins_and_need_no_neighbours():
    sizes = np.array([0, 40, 7, 300, 0, 1, 90, 12, 55, 8])
    deal = sharding.Deal(sizes, 6, 3)
    counts = np.array([np.diff(deal.ends(p), prepend=0) for p in range(len(sizes))])
    assert counts.sum(axis=1).tolist() == sizes.tolist()
    assert counts.sum(axis=0).tolist() == sharding.shard_sizes(int(sizes.sum()), 6)
    alone = sharding.Deal(sizes, 6, 3)  # another task that meets one partition only
    assert np.diff(alone.ends(6), prepend=0).tolist() == counts[6].tolist()
    got = np.concatenate([deal.shards(3, np.arange(0, 150)), deal.shards(3, np.arange(150, 300))])
    assert np.bincount(got, minlength=6).tolist() == counts[3].tolist()


def test_rows_are_not_exchanged_before_they_are_dealt(spark, tmp_path):
    df = spark.range(0, 100, 1, 4)
    plan = sharding.shuffle_into_shards(df, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 2  # the slots and the bases of a shard's buckets


def test_each_row_is_as_likely_in_each_shard(spark):
    hits = Counter()
    for seed in range(40):
        rows = sharding.shuffle_into_shards(spark.range(0, 60, 1, 5), 4, seed=seed).collect()
        hits.update((r.id // 12, r.shard) for r in rows)
    assert all(abs(hits[p, s] - 120) < 50 for p in range(5) for s in range(4))  # 480 rows a partition, deviation below 10

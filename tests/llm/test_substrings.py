"""Suffix arrays, and repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from spindle.llm import queries, substrings
from spindle.llm.suffixarray import common_prefixes, suffix_array


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(1)
    for trial in range(250):
        n, letters = int(rng.integers(1, 70)), int(rng.integers(1, 5))
        data = rng.integers(0, letters, n).astype(np.uint8)
        if trial % 3 == 0:
            data = np.tile(data[:max(1, n // 4)], 4)
        raw = data.tobytes()
        order = suffix_array(data, 10**6)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        shared = common_prefixes(data, order)
        for a, b in zip(order, order[1:], strict=False):
            n_same = next((k for k in range(len(raw)) if raw[a + k:a + k + 1] != raw[b + k:b + k + 1] or not raw[b + k:b + k + 1]), len(raw))
            assert shared[b] == n_same
    assert len(suffix_array(np.zeros(0, np.uint8), 10)) == 0


def test_bounded_depth_sorts_that_deep():
    rng = np.random.default_rng(2)
    data = np.tile(rng.integers(0, 3, 300).astype(np.uint8), 5)
    raw = data.tobytes()
    order = suffix_array(data, 40)
    assert sorted(order.tolist()) == list(range(len(raw)))
    assert all(raw[a:a + 40] <= raw[b:b + 40] for a, b in zip(order, order[1:], strict=False))


def brute(docs, length):
    seen = {}
    for _, text in docs:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for doc_id, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(int)) == 1)
        left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((doc_id if doc_id is not None else -1, len(raw), int(gone.sum()), len(edges), hashlib.sha256(left).hexdigest()))
    return sorted(out)


def removed(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "'x' as grp", "2 as n_bytes")
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in substrings.remove_repeats(df, **options).collect())


@pytest.mark.parametrize("sizes", [{}, {"group_bytes": 60, "shard_bytes": 500}])
def test_against_brute_force(spark, sizes):
    rng = random.Random(7)
    say = lambda n, letters="abcdefgh é": "".join(rng.choice(letters) for _ in range(n))
    passages = [say(rng.randint(20, 120)) for _ in range(6)]
    docs = [(i, say(rng.randint(0, 60)) + rng.choice(passages)[rng.randint(0, 9):] + say(rng.randint(0, 60))) for i in range(60)]
    docs += [(100, "a" * 300), (101, "ab" * 100), (102, "x" + "a" * 50 + "y"), (103, passages[0]), (104, passages[0]),
             (105, passages[1] + passages[1]), (106, passages[2] * 3), (107, say(200, "ab")), (108, None), (109, ""), (None, passages[0]),
             (110, "dup row " * 9), (110, "dup row " * 9), (111, "z" * 19), (112, "q" * 20), (113, "r" * 21)]
    base = say(150)
    docs += [(200 + i, base[:i * 3] + "#" + base[i * 3 + 1:]) for i in range(45)]  # near copies with edits everywhere
    assert removed(spark, docs, length=20, gram=5, **sizes) == brute(docs, 20)


def test_edge_cases(spark):
    assert removed(spark, []) == []
    long = "".join(random.Random(1).choice("abcdefghij ") for _ in range(200_000))
    docs = [(1, long), (2, "head " + long[1000:2000]), (3, "short"), (3, "short")]
    assert removed(spark, docs) == brute(docs, 400)


def test_query_over_the_table(spark):
    from conftest import SF
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.op8_suffix_array_dedup(spark, SF)
                 .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == brute(docs, 400)

"""BagMinHash: unbiased signatures, exact groups, hot groups."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from spindle.llm import bagminhash, clusters, queries
from spindle.llm.components import connected_components
from spindle.llm.shingles import expanded, multisets, shingle_hashes


def tokens(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())


def bag(text):
    w = tokens(text)
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(docs, similarity=0.8):
    """Groups of row numbers connected by weighted Jaccard similarity; texts without words stay alone."""
    bags = [bag(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if bags[i] and bags[j] and group[i] != group[j] and jaccard(bags[i], bags[j]) >= similarity - 1e-12:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    members = {}
    for i, g in enumerate(group):
        members.setdefault(g, []).append(docs[i][0])
    return sorted(sorted(m, key=str) for m in members.values())


def groups(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "'x' as class", "2 as size", "'g' as `group`")
    members = {}
    for r in bagminhash.near_duplicates(df, **options).collect():
        members.setdefault(r.group, []).append(r.doc_id)
    return sorted(sorted(m, key=str) for m in members.values())


def test_shingles_are_those_of_the_words():
    texts = ["", "One two", "a b c d e f a b c d e", "Don't STOP, now! now? now. now now now now now", "é È été ça va très bien", "x" * 5000 + " y"]
    values, owner = shingle_hashes(texts)
    seen = {}
    for n, text in enumerate(texts):
        mine = values[owner == n]
        want = [tuple(tokens(text)[i:i + 5]) for i in range(len(tokens(text)) - 4)] if len(tokens(text)) > 4 else [tuple(tokens(text))] * bool(tokens(text))
        assert len(mine) == len(want)
        for h, s in zip(mine, want, strict=True):
            assert seen.setdefault(int(h), s) == s
        distinct, own, count = multisets(mine, np.zeros(len(mine), int))
        assert sorted(count.tolist()) == sorted(Counter(want).values())
        assert len(np.unique(expanded(mine, np.zeros(len(mine), int))[0])) == len(mine)
    assert len(seen) == sum(len(set(bag(t))) for t in texts)


def test_signatures_agree_with_the_weighted_jaccard_probability():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**63, 60).astype(np.uint64)
    weights = [rng.integers(1, 12, 60), rng.integers(1, 12, 60)]
    sets = [np.arange(0, 45), np.arange(15, 60)]
    want = [np.zeros(60, int), np.zeros(60, int)]
    for w, s, v in zip(weights, sets, want, strict=True):
        v[s] = w[s]
    truth = np.minimum(*want).sum() / np.maximum(*want).sum()
    hashes = np.concatenate([keys[s] for s in sets])
    owner = np.repeat([0, 1], [45, 45])
    weight = np.concatenate([w[s] for w, s in zip(weights, sets, strict=True)])
    sig = bagminhash.signatures(hashes, owner, weight, 2, 8192)
    assert np.isfinite(sig).all()
    assert abs((sig[0] == sig[1]).mean() - truth) < 5 * np.sqrt(truth * (1 - truth) / 8192)
    alone = bagminhash.signatures(keys[sets[0]], np.zeros(45, int), weights[0][sets[0]], 1, 8192)
    assert (alone[0] == sig[0]).all()


def test_block_search_tests():
    rng = random.Random(5)
    sets = [np.unique(np.array([rng.randrange(40) for _ in range(30)], np.int64)) for _ in range(40)]
    for columns in (7, 4096):
        got = clusters.jaccard_sets(0.5, columns)(sets[:25], sets[25:])
        for i, a in enumerate(sets[:25]):
            for j, b in enumerate(sets[25:]):
                assert got[i, j] == (len(set(a) & set(b)) >= 0.5 * len(set(a) | set(b)))
    similar = np.array([[1, 1, 0], [0, 1, 0], [0, 0, 0]], bool)
    assert clusters.spanning(similar, [1, 2, 3], [7, 8, 9]) == [(1, 7), (1, 8), (2, 8)]
    assert clusters.spanning(np.ones((3, 3), bool), [1, 2, 3], [7, 8, 9]) == [(1, 7), (1, 8), (1, 9), (2, 7), (3, 7)]


def near_copies(seed, n, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(9999)}" for _ in range(120)]
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(120), edits):
            words[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_groups_equal_brute_force_in_a_hot_group(spark, edits, monkeypatch):
    """Near copies around the threshold: every link between different texts counts."""
    texts = near_copies(9, 90, edits) + near_copies(10, 40, 1) + [f"something else number {i} that shares little with it" for i in range(20)]
    docs = list(enumerate(texts)) + [(1000 + i, texts[0]) for i in range(30)]
    monkeypatch.setattr(clusters.linked, "__defaults__", (16,))  # several blocks
    assert groups(spark, docs) == brute(docs)


def test_edge_cases(spark):
    long = " ".join(f"t{i % 977}" for i in range(60_000))
    docs = [(1, None), (2, ""), (3, "!!!"), (3, "!!!"), (None, "one two"), (4, "One, two!"), (5, "one two three"), (6, long), (7, long + " end"),
            (8, "a b c d e " * 50), (9, "a b c d e " * 10), (10, "same row of text here"), (10, "same row of text here"), (11, "one")]
    assert groups(spark, docs) == brute(docs)
    assert groups(spark, []) == []


def test_one_document_of_each_group_stays(spark):
    texts = near_copies(3, 6, 1)
    rows = [(9, texts[0], "a", 1), (4, texts[1], "b", 2), (7, texts[2], "c", 3), (4, texts[1], "b", 2), (None, texts[3], "d", 4), (12, None, None, 5),
            (13, "", "e", 6), (14, "alone in the world of texts", "f", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `group` string, _known int")
    kept = bagminhash.first_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted(tuple(r)[0] for r in kept.collect()) == [4, 12, 13, 14]


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 100: 100, 101: 100, 103: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_query_over_the_table(spark):
    from conftest import SF
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    members = {}
    for r in queries.op10_bag_minhash(spark, SF).collect():
        members.setdefault(r.class_id, []).append(r.doc_id)
    assert sorted(sorted(m, key=str) for m in members.values()) == brute(docs)
    assert all(k == min(v) for k, v in members.items())

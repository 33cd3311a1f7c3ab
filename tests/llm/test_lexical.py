"""Ranked lexical search: brute force over terms, ties, blocks of items, defined cases."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from spindle.llm import lexical, queries

TERM = re.compile(lexical.TERM)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(documents, items, k=50):
    bags = [(d, Counter(terms(t))) for d, t in documents]
    n_docs = sum(bool(b) for _, b in bags)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, want in wanted.items():
        scored = []
        for d, b in bags:
            if b:
                m = 50 + (50 * sum(b.values()) * n_docs) // total
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10**9 * b[t]) // (1000 * b[t] + 20 * m)) for t in want if b[t])
                if s > 0:
                    scored.append((-s, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frames(spark, documents, items):
    return (spark.createDataFrame(documents, "doc_id bigint, text string"),
            spark.createDataFrame(items, "item_id bigint, text string"))


def test_the_tables_against_brute_force(spark):
    from conftest import SF
    documents = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert result(queries.op11_lexical_search(spark, SF)) == brute(documents, items)


DOCUMENTS = [(1, "red Fox, red hen"), (2, "RED fox"), (3, "blue whale"), (4, None), (5, ""), (6, "... --- \x7f"), (None, "red fox"),
             (7, "fox" * 50_000), (8, "été Été naïve"), (9, "red fox"), (9, "red fox"), (10, "a_b a-b fox\x00red"),
             (11, "日本 red\U0001f600 fox"), (12, "red " * 30_000)]
ITEMS = [(1, "Red fox"), (2, "ÉTÉ été"), (3, "nothing here"), (4, "日本 red\U0001f600"), (5, ""), (6, None), (1, "whale"),
         (None, "hen"), (7, "fox" * 50_000), (8, "a b")]


def test_defined_cases(spark):
    documents, items = frames(spark, DOCUMENTS, ITEMS)
    documents = documents.withColumn("score", F.lit("x")).withColumn("item_id", F.lit(1))
    assert result(lexical.rank_documents(documents, items.withColumn("term", F.lit(2)))) == brute(DOCUMENTS, ITEMS)
    assert result(lexical.rank_documents(documents, items, k=2)) == brute(DOCUMENTS, ITEMS, k=2)


def test_empty_tables(spark):
    documents, items = frames(spark, DOCUMENTS, ITEMS)
    for d, i in ((documents.limit(0), items), (documents, items.limit(0)), (documents.filter("doc_id in (4, 5, 6)"), items)):
        got = lexical.rank_documents(d, i)
        assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    documents, items = frames(spark, DOCUMENTS, ITEMS)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 2)
    assert len(list(lexical.item_blocks(items))) == 4
    assert result(lexical.rank_documents(documents, items)) == brute(DOCUMENTS, ITEMS)
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 1)
    assert len(list(lexical.item_blocks(items))) == 7


def test_copies_beyond_k_go_by_id_over_many_tasks(spark):
    rng = np.random.default_rng(5)
    ids = rng.permutation(3000)
    rows = [(int(i), "one copied text" if i % 3 else f"other {i} text") for i in ids]
    documents, items = frames(spark, rows, [(1, "copied text"), (2, "other 900")])
    assert result(lexical.rank_documents(documents.repartition(16), items)) == brute(rows, [(1, "copied text"), (2, "other 900")])


def test_sums_beyond_doubles_are_exact():
    weights = lexical.Weights(10, 100, np.full(3, 2**40, np.int64))
    got = lexical.item_scores(weights, np.ones((3, 1), np.uint8), np.array([9]), np.zeros(3, int), np.arange(3), np.ones(3, int))
    m = 50 + (50 * 9 * 10) // 100
    assert got[0, 0] == 3 * 2**40 * (10**9 // (1000 + 20 * m)) > 2**53


def test_long_lengths_do_not_overflow():
    weights = lexical.Weights(10**12, 10**15, np.ones(1, np.int64))
    assert weights.length_factor(np.array([10**9])).tolist() == [50 + 50 * 10**9 * 10**12 // 10**15]

"""Quality classifier: held-out accuracy, the discriminant's algebra, edge cases."""

import zlib

import numpy as np

from spindle.llm import quality, queries


def test_held_out_accuracy(spark):
    from conftest import SF
    sf = SF.replace("sf0.001", "sf0.01")
    scored = queries.op9_quality_classifier(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert scored.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in scored.limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_scores_are_log_density_differences():
    rng = np.random.default_rng(0)
    d = 3
    x = [rng.normal(size=(400, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) for _ in range(2)]
    n = np.array([len(v) for v in x], float)
    model = quality.discriminant(n, np.array([v.sum(0) for v in x]), np.array([v.T @ v for v in x]), 0.2, 0.05, 1.0)
    cov = [np.cov(v.T, bias=True) for v in x]
    pooled = sum(c * k for c, k in zip(cov, n, strict=True)) / n.sum()
    scale = np.diag(np.sqrt(np.diag(pooled)))
    points = rng.normal(size=(20, d))
    log = []
    for v, c, k in zip(x, cov, n, strict=True):
        s = 0.95 * (0.8 * c + 0.2 * pooled) + 0.05 * scale @ scale
        diff = points - v.mean(0)
        log.append(np.log(k / n.sum()) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(s), diff))
    assert np.allclose(model.score(points), 1 / (1 + np.exp(log[0] - log[1])))


def test_held_out_labels_are_not_used(spark):
    docs = spark.createDataFrame([(i, ("fine words here " if i % 2 else "### $$$ %%% ") * (1 + i % 7)) for i in range(200)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(200)]
    flipped = [(i, q if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - q) for i, q in labels]
    runs = [{r.doc_id: r.score for r in quality.score_documents(docs, spark.createDataFrame(rows, "doc_id long, quality int")).collect()}
            for rows in (labels, flipped)]
    assert runs[0] == runs[1]
    assert all((s > 0.7) == bool(i % 2) for i, s in runs[0].items())


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "text of some words"), (3, "x" * 300_000), (4, "same"), (4, "same"), (5, "\ud83d ok".encode("utf-8", "ignore").decode())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "'f' as features", "0 as quality")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.score_documents(docs, none).collect()
    assert len(got) == 7 and all(r.score == 0.5 and r.predicted == 0 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, 7), (3, None), (None, 1), (4, 1), (4, 1), (5, 0)], "doc_id long, quality int")
    got = quality.score_documents(docs, odd).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert quality.score_documents(docs.limit(0), odd).collect() == []
    kept = quality.accepted_documents(docs, none, accept=0.5)
    assert kept.columns == docs.columns and kept.count() == 7
    assert quality.accepted_documents(docs.limit(0), odd).collect() == []

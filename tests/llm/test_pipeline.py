"""The pipeline's stages, each against its own input."""

import corpus_pipeline
from test_bagminhash import brute as near_groups
from test_decontaminate import brute as leaks
from test_packing import check

from spindle.llm import packing, quality
from spindle.llm.common import keep


def test_stages(spark):
    from conftest import SF
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = docs
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        steps[name] = rows = keep(stage(spark, rows, SF), "stage")
        assert name == "packing" or rows.columns == columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    text = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    start, good = text(docs), text(steps["quality"])
    scored = {r.doc_id: r.predicted for r in quality.score_documents(docs, labels.select("doc_id", "quality")).collect()}
    assert set(good) == {d for d, p in scored.items() if p} and all(start[d] == t for d, t in good.items())

    lines = text(steps["line_dedup"])
    assert set(lines) < set(good)
    for d, t in lines.items():
        left = iter(good[d].split("\n"))
        assert all(x in left for x in t.split("\n"))  # a subsequence of the lines
    assert all(r.n_chars == len(r.text) for r in steps["line_dedup"].collect())

    kept = text(steps["near_dedup"])
    assert sorted(kept) == sorted(min(g) for g in near_groups(list(lines.items())))

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = text(steps["decontamination"])
    assert set(clean) == set(kept) - {d for d, _ in leaks(list(kept.items()), bench)}

    check(steps["packing"].collect(), {d: len(t.encode()) for d, t in clean.items()}, packing.CAPACITIES)


def test_run_is_the_stages_in_turn(spark):
    import __spark_entry__ as E
    from conftest import SF
    assert E.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_empty_documents(spark):
    from conftest import SF
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        rows = keep(stage(spark, rows, SF), "stage")
        assert rows.count() == 0


def test_queries_are_registered():
    import __spark_entry__ as E
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))

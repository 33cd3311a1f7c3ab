"""Every catalogue query against its DuckDB oracle (sf0.001 keeps it quick)."""

import os

import sys
sys.path.insert(0, os.path.dirname(__file__))
from oracle_compare import compare  # noqa: E402

SF = os.environ.get("SPINDLE_TEST_SF", "/root/testdata/sf0.001")


def test_all_queries_match_oracle(spark):
    import __spark_entry__ as E
    results = compare(spark, SF, [n for n in E.queries() if n in E.oracle_sql()], verbose=False)
    bad = {k: v for k, v in results.items() if "values" in v and not v["values"]}
    assert not bad, bad
    assert len(results) >= 24


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["word", "n"] and len(rows) == 5


def test_every_catalogue_query_has_oracle_sql():
    from spindle.plans import catalog
    assert set(catalog.queries()) == set(catalog.oracle_sql())

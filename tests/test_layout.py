"""SET-1 and PRT-1..4 on the literal lists of the practice program."""

from spindle.operators import layout
from spindle.sources import int_list


def _report(df):
    return [(r.partition, r.n_rows, r.min_value, r.max_value)
            for r in layout.partition_report(df).orderBy("partition").collect()]


def test_union_coalesce_repartition(spark):
    a = int_list(spark, [1, 2, 3, 4, 5, 6], 3)
    b = int_list(spark, [7, 8, 9, 10, 11], 2)
    u = layout.union_all(a, b)
    assert layout.num_partitions(u) == 5
    assert _report(u) == [(0, 2, 1, 2), (1, 2, 3, 4), (2, 2, 5, 6), (3, 2, 7, 8), (4, 3, 9, 11)]
    c = layout.coalesce_to(u, 3)
    assert layout.num_partitions(c) == 3
    assert sum(r[1] for r in _report(c)) == 11
    r = layout.repartition_to(c, 10)
    rep = _report(r)
    assert len(rep) == 10 and sum(x[1] for x in rep) == 11  # empty partitions listed too
    sizes = {s.stage: (s.n_partitions, s.n_rows) for s in
             layout.layout_sizes([("union", u, 5), ("coalesce", c, 3), ("repartition", r, 10)]).collect()}
    contents = {}
    for row in layout.partition_contents(u).collect():
        contents.setdefault(row.partition, []).append(row.value)
    assert contents == {0: [1, 2], 1: [3, 4], 2: [5, 6], 3: [7, 8], 4: [9, 10, 11]}
    assert sizes == {"union": (5, 11), "coalesce": (3, 11), "repartition": (10, 11)}


def test_the_flow_sees_all_stages_in_one_pass(spark):
    a, b = int_list(spark, [1, 2, 3, 4, 5, 6], 3), int_list(spark, [7, 8, 9, 10, 11], 2)
    got = {r.stage: (r.n_partitions, r.n_held, r.n_rows) for r in layout.layout_flow([(a, 3), (b, 2)], 3, 10).collect()}
    assert got["union"] == (5, 5, 11) and got["coalesce"] == (3, 3, 11)
    assert got["repartition"][0] == 10 and got["repartition"][2] == 11
    few = {r.stage: (r.n_partitions, r.n_rows) for r in layout.layout_flow([(a.limit(0), 3), (b.limit(0), 2)], 9, 4).collect()}
    assert few == {"union": (5, 0), "coalesce": (5, 0), "repartition": (4, 0)}


def test_empty_partitions_are_listed(spark):
    from pyspark.sql import functions as F
    df = spark.range(6).repartitionById(8, (F.col("id") * 3 % 8).cast("int")).filter("id <> 4")
    got = sorted(((r.partition, r.value, r.empty) for r in layout.partition_listing(df, "id", 8).collect()), key=repr)
    assert [x for x in got if not x[2]] == [(0, 0, False), (1, 3, False), (3, 1, False), (6, 2, False), (7, 5, False)]
    assert [x[:2] for x in got if x[2]] == [(2, None), (4, None), (5, None)]
    assert layout.partition_listing(df.filter("id > 9"), "id", 8).filter("empty").count() == 8

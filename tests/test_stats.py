"""Golden values of the keyed and global statistics (AGG-1..8, LIM-1, FLT-1)."""

import pytest

from spindle.operators import stats
from spindle.sources import int_range, key_values


def test_range_stats(spark):
    nums = int_range(spark, 100, 1000, 7)
    assert nums.rdd.getNumPartitions() == 7
    assert [r.id for r in stats.head(nums, 5).collect()] == [100, 101, 102, 103, 104]
    g = stats.global_stats(nums).first()
    assert (g.total, g.n, g.mean, g.n_even) == (495550, 901, 550.0, 451)
    evens = stats.filter_even(nums)
    assert [r.id for r in stats.head(evens, 5).collect()] == [100, 102, 104, 106, 108]


def test_avg_by_key(spark):
    kv = key_values(spark, [("coffee", 1), ("coffee", 3), ("panda", 4), ("coffee", 5),
                            ("street", 2), ("panda", 5)])
    got = {r.key: r.avg_value for r in stats.avg_by_key(kv).collect()}
    assert got == {"coffee": 3.0, "panda": 4.5, "street": 2.0}


def test_xyz_by_id(spark):
    lines = spark.createDataFrame([(v,) for v in ["1,23,5600,5", "2,30,5800,7", "1,27,5000,10",
                                                   "3,24,6900,5", "2,45,5800,7", "2,28,5800,7"]],
                                  "value string")
    got = {r.id: (r.max_y, r.min_z, r.avg_x) for r in stats.xyz_by_id(stats.parse_longs(lines)).collect()}
    assert got[1] == (5600, 5, 25.0)
    assert got[2][:2] == (5800, 7) and got[2][2] == pytest.approx(34.333333333333336)
    assert got[3] == (6900, 5, 24.0)


def test_status_counts(spark):
    lines = spark.createDataFrame([(v,) for v in ["400,x", "200,y", "404,z", "200,w", "500"]],
                                  "value string")
    r = stats.status_counts(stats.parse_status(lines)).first()
    assert (r.total, r.n_400, r.n_200) == (5, 1, 2)


def test_empty_input_sum_is_null(spark):
    empty = spark.range(0)
    r = stats.global_stats(empty).first()
    assert r.total is None and r.n == 0 and r.n_even == 0

"""PRJ-5 / PRJ-6 strict parsing."""

import pytest
from pyspark.errors import PySparkException

from spindle.operators import stats


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_longs_good(spark):
    rows = stats.parse_longs(_lines(spark, ["1,23,5600,5", "1,2,3,4,5", "-7,+8,9,10"])).collect()
    assert [tuple(r) for r in rows] == [(1, 23, 5600, 5), (1, 2, 3, 4), (-7, 8, 9, 10)]


@pytest.mark.parametrize("bad", ["1,23,5600", "1,x,5600,5", "1, 23,5600,5", "1,2,,4",
                                 "1,2,3,99999999999999999999"])
def test_parse_longs_bad_fails(spark, bad):
    with pytest.raises(PySparkException):
        stats.parse_longs(_lines(spark, [bad])).collect()


def test_parse_status(spark):
    codes = stats.parse_status(_lines(spark, ["400,a,b", "200", "500,x"]))
    assert [r.code for r in codes.collect()] == [400, 200, 500]
    with pytest.raises(PySparkException):
        stats.parse_status(_lines(spark, ["OK,1"])).collect()

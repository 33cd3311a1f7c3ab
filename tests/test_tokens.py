"""PRJ-1 / PRJ-2 tokenisers and text-file line splitting."""

import pytest
from pyspark.sql import functions as F

from spindle.functions.tokens import clean_tokens, space_tokens, text_lines

# line -> tokens of a split on one space that drops trailing empty tokens
SPACE_CASES = [
    ("", [""]),
    (" ", []),
    ("   ", []),
    ("a  b ", ["a", "", "b"]),
    (" a", ["", "a"]),
    ("a b   ", ["a", "b"]),
    ("a\tb", ["a\tb"]),
    ("x y z", ["x", "y", "z"]),
]


def _eval(spark, expr, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_space_tokens(spark):
    got = _eval(spark, space_tokens, [c[0] for c in SPACE_CASES])
    assert got == [c[1] for c in SPACE_CASES]


@pytest.mark.parametrize("line,expected", [
    ("don't well-known - The", ["dont", "wellknown", "The"]),
    ("  Hello,   world!  ", ["Hello", "world"]),
    ("a\tb\nc", ["a", "b", "c"]),
    ("...", []),
    ("", []),
    ("\x01a\x02 b\x03c", ["a", "b\x03c"]),
    ("x\x0by", ["x", "y"]),
    ("What? No: yes.", ["What", "No", "yes"]),
])
def test_clean_tokens(spark, line, expected):
    assert _eval(spark, clean_tokens, [line]) == [expected]


@pytest.mark.parametrize("text,lines", [
    ("a\nb", ["a", "b"]),
    ("a\nb\n", ["a", "b"]),
    ("a\r\nb\rc", ["a", "b", "c"]),
    ("a\n\nb", ["a", "", "b"]),
    ("\n", [""]),
    ("", []),
    ("one", ["one"]),
])
def test_text_lines(spark, text, lines):
    assert _eval(spark, text_lines, [text]) == [lines]


def test_text_lines_null(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert df.select(text_lines(F.col("v"))).first()[0] is None

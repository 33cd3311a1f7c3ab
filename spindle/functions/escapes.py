"""One-line text fields: escapes for line breaks, backslashes and NULL, and strict parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_FIELD = r"\N"


def escape_field(value: Column) -> Column:
    r"""The value as text without line breaks: ``\`` -> ``\\``, LF -> ``\n``, CR -> ``\r``, NULL -> ``\N``."""
    text = value.cast("string")
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return F.coalesce(text, F.lit(NULL_FIELD))


def unescape_field(text: Column) -> Column:
    r"""Inverse of :func:`escape_field`; what lies between doubled backslashes holds the other escapes."""
    def breaks(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    plain = F.array_join(F.transform(F.split(text, r"\\\\", -1), breaks), "\\")
    return F.when(text == NULL_FIELD, F.lit(None)).when(F.instr(text, "\\") > 0, plain).otherwise(text)


def parsed_field(line: Column, pattern: str, group: int) -> Column:
    """A group of ``pattern`` in the line; a line that does not match fails the job."""
    problem = F.raise_error(F.concat(F.lit("unreadable line: "), line))
    return F.when(line.rlike(pattern), F.regexp_extract(line, pattern, group)).otherwise(problem)

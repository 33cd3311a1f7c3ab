"""Tokenisers as native column expressions (PRJ-1, PRJ-2, FN-1).

All three return ``array<string>`` columns meant to be consumed at once by
``explode``; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line terminators of a text file, and the punctuation the cleaning
# tokeniser deletes (deleted, not replaced by a space).
LINE_BREAK = r"\r\n|\r|\n"
DELETED_PUNCTUATION = "'.,:?!-"
# Java's \s class: space, tab, newline, vertical tab, form feed, carriage return.
WHITESPACE = r"[ \t\n\x0B\f\r]"
# Characters <= U+0020 that are not in WHITESPACE; a token keeps them inside but
# loses them at its two ends (Java-style trim).
EDGE_CONTROL = r"[\x00-\x08\x0E-\x1F]"



def _empty() -> Column:
    return F.array().cast("array<string>")


def text_lines(text: Column) -> Column:
    """Split a whole text into lines like a text-file reader would.

    ``\\n``, ``\\r`` and ``\\r\\n`` end a line; a terminator at the very end does not
    open one more (empty) line; an empty text has no lines; NULL stays NULL.
    """
    n = F.length(text)
    cut = (F.when(text.endswith(F.lit("\r\n")), 2)
             .when(text.endswith(F.lit("\n")) | text.endswith(F.lit("\r")), 1)
             .otherwise(0))
    body = F.substring(text, F.lit(1), n - cut)
    # texts without a carriage return take the single-character split (no regex)
    lines = F.when(F.instr(body, "\r") > 0, F.split(body, LINE_BREAK, -1)).otherwise(
        F.split(body, "\n", -1))
    return F.when(text == "", _empty()).otherwise(lines)


def space_tokens(line: Column) -> Column:
    """PRJ-1: split on single spaces, dropping trailing empty tokens.

    Leading and interior empty tokens stay; an empty line gives one empty token;
    a line of spaces only gives none.
    """
    stripped = F.rtrim(line)  # rtrim removes U+0020 only
    return F.when((line != "") & (stripped == ""), _empty()).otherwise(F.split(stripped, " ", -1))


def clean_tokens(line: Column) -> Column:
    """PRJ-2: delete punctuation, split on whitespace, trim, drop empty tokens.

    Trimming is done on the whole line (control characters at a token's edges are
    removed before the split) so no per-token regex runs.  Case is kept.
    """
    no_punct = F.translate(line, DELETED_PUNCTUATION, "")  # unmatched characters are deleted
    edges = rf"(?:^|(?<={WHITESPACE})){EDGE_CONTROL}+|{EDGE_CONTROL}+(?={WHITESPACE}|\z)"
    # the edge regex only runs on the rare lines holding such control characters
    trimmed = F.when(no_punct.rlike(EDGE_CONTROL), F.regexp_replace(no_punct, edges, "")).otherwise(no_punct)
    return F.filter(F.split(trimmed, WHITESPACE + "+", -1), lambda w: w != "")

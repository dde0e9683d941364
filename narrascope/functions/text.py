"""Column functions over narrative and question text.

Everything here is a JVM expression: it pipelines with the scan, works on batch and
streaming frames alike and never leaves the executor for Python.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------

BOILERPLATE = [
    r"i am writing to (?:file|submit) a complaint(?: about| regarding)?",
    r"i am writing to you to (?:file|submit|express)",
    r"to whom it may concern",
    r"this is a complaint (?:about|regarding)",
]

KEPT_CHARACTERS = string.ascii_lowercase + string.digits + ".,!?'"

# Java's plain \s is ASCII; (?U) gives the Unicode White_Space property.
NOT_SPACE = r"(?U)\S"
SPACES = r"(?U)\s+"
OUTER_SPACES = r"(?U)^\s+|\s+$"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def has_text(c: Column) -> Column:
    """True for text with a visible character; null and blank text give null and false."""
    return c.rlike(NOT_SPACE)


def strip(c: Column) -> Column:
    """Drop Unicode white space at both ends (``trim`` alone drops U+0020 only)."""
    return F.regexp_replace(c, OUTER_SPACES, "")


def word_count(c: Column) -> Column:
    """Runs of non-space characters; null counts as no words."""
    return F.regexp_count(text_or_empty(c), F.lit(NOT_SPACE + "+"))


def normalise(c: Column) -> Column:
    """Lower-case text without redactions, boilerplate openers and unusual characters.

    A redaction is any run of two or more ``x``, also inside a word. Openers go before
    spaces are collapsed, so an opener written with a doubled space stays. The last
    replacement blanks every run of characters that are not kept, and white space is
    never kept, so it collapses spaces in the same pass.
    """
    text = F.lower(text_or_empty(c))
    text = F.regexp_replace(text, "x{2,}", " ")
    text = F.regexp_replace(text, f"(?=[it])(?:{'|'.join(BOILERPLATE)})", " ")
    text = F.regexp_replace(text, f"[^{KEPT_CHARACTERS}]+", " ")
    return F.trim(text)


def shorten(c: Column, n: int = 160) -> Column:
    """Text on one line, cut to ``n`` characters with an ellipsis when longer."""
    line = strip(F.regexp_replace(c, SPACES, " "))
    return F.when(F.length(line) > n, F.concat(F.substring(line, 1, n), F.lit("…"))).otherwise(line)


def excerpt(c: Column, n: int = 120) -> Column:
    return F.substring(c, 1, n)


def escape_pipes(c: Column) -> Column:
    return F.replace(c, F.lit("|"), F.lit("\\|"))


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that later filters on it do not compute it again.

    A filter is pushed below a projection with the whole expression copied into it, but
    not below a generator; this one yields exactly one row per row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def or_question_mark(c: Column) -> Column:
    """``?`` for a missing value; an empty string is a value and stays."""
    return F.coalesce(c, F.lit("?"))

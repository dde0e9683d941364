import pytest
from pyspark.sql import functions as F

from narrascope.functions import text as X

CASES = [
    ("I am writing to file a complaint about XXXX charges!!!", "charges!!!"),
    (None, ""),
    ("Exxon MAXX café $5.00", "e on ma caf 5.00"),
    ("XXXX", ""),
    ("I am writing  to file a complaint", "i am writing to file a complaint"),
    ("To whom it may concern: pay", "pay"),
    ("i am writing to you to express anger", "anger"),
    ("This is a complaint regarding fees", "fees"),
    ("I am writingXXto submit a complaint about you", "you"),
    ("a b　c\t\nd", "a b c d"),
    ("it's 5% (more), ok? \U0001f600!", "it's 5 more , ok? !"),
    ("   ", ""),
]


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t"))).first()[0]


@pytest.mark.parametrize("given, wanted", CASES)
def test_normalise(spark, given, wanted):
    assert one(spark, given, X.normalise) == wanted


@pytest.mark.parametrize(
    "given, words, visible",
    [("a b \tc", 3, True), ("", 0, False), ("\t\n ", 0, False), ("　", 0, False), (None, 0, None)],
)
def test_words_and_blanks(spark, given, words, visible):
    assert one(spark, given, X.word_count) == words
    assert one(spark, given, X.has_text) is visible


def test_shorten(spark):
    assert one(spark, "  a \n b  c ", lambda c: X.shorten(c, 5)) == "a b c"
    assert one(spark, "abcdef", lambda c: X.shorten(c, 5)) == "abcde…"
    assert one(spark, "a|b", X.escape_pipes) == "a\\|b"
    assert one(spark, None, X.or_question_mark) == "?"
    assert one(spark, "", X.or_question_mark) == ""
    assert one(spark, "　 why? \n", X.strip) == "why?"
    assert one(spark, "x" * 200, X.excerpt) == "x" * 120

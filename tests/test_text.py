import pytest
from pyspark.sql import functions as F

from slackline.operators import text
from slackline.plans.fixtures import word_flags, word_polarity
from slackline.sources.text import split_lines
from tests.conftest import values


@pytest.fixture
def lines(spark):
    rows = [
        (1, 0, "The the THE. of was"),
        (1, 1, "nothing listed here"),
        (2, 0, "for  for\tfor,"),
    ]
    return spark.createDataFrame(rows, "doc int, line int, text string")


def test_punctuation_stays_on_the_word(lines):
    out = [r[0] for r in lines.select(text.tokens("text")).collect()]
    assert out[0] == ["THE", "THE", "THE.", "OF", "WAS"]
    assert out[2] == ["FOR", "FOR", "FOR,"]


def test_counts_keep_lines_without_hits(spark, lines):
    out = text.lexicon_counts(lines, ["doc", "line"], "text", word_flags(spark))
    assert values(out, "doc", "line", "positive", "negative", "uncertainty", "weak_modal") == [
        (1, 0, 2, 1, 1, 0), (1, 1, 0, 0, 0, 0), (2, 0, 0, 0, 2, 2),
    ]
    totals = text.lexicon_totals(out, ["negative", "positive", "uncertainty"]).first()
    assert tuple(totals) == (1, 2, 3)


def test_counts_by_shuffle_join_are_the_same(spark, lines, conf):
    expected = values(text.lexicon_counts(lines, ["doc", "line"], "text", word_flags(spark)))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert values(text.lexicon_counts(lines, ["doc", "line"], "text", word_flags(spark))) == expected
    conf("spark.sql.adaptive.enabled", "false")
    assert values(text.lexicon_counts(lines, ["doc", "line"], "text", word_flags(spark))) == expected


def test_polarity(spark, lines):
    out = text.polarity(lines, ["doc", "line"], "text", word_polarity(spark))
    assert values(out, "doc", "line", "polarity", "subjectivity", "intensity") == [
        (1, 0, 0.0625, 0.4375, 0.0625), (1, 1, 0.0, 0.0, 0.0), (2, 0, 0.75, 0.5, 0.75),
    ]
    assert tuple(text.polarity_means(out).first()) == pytest.approx((0.8125 / 3, 0.9375 / 3))


def test_label_is_the_start_of_the_line(spark):
    rows = spark.createDataFrame([("x" * 60,)], "text string")
    assert rows.select(F.length(text.label("text"))).first()[0] == 50


def test_lines_are_stripped_and_blank_ones_dropped(spark):
    docs = spark.createDataFrame([(1, " a \r\n\n  \n\tb\rc")], "doc int, text string")
    assert values(split_lines(docs, ["doc"], "text"), "line_no", "text") == [(0, "a"), (3, "b"), (4, "c")]


def test_word_frequency(spark):
    docs = spark.createDataFrame([("b a b",), (None,), ("  ",), ("c a",)], "text string")
    assert [tuple(r) for r in text.word_frequency(docs, "text", 2).collect()] == [("A", 2), ("B", 2)]

"""Lexicon scores of text lines and word frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slackline.fixed_values import SENTIMENTS
from slackline.functions.joins import lookup_join
from slackline.schema import inline_table
from slackline.sources.text import SPACE, strip

LABEL_LENGTH = 50


def tokens(text: str) -> Column:
    """Upper-case words split at white space; punctuation stays on the word."""
    return F.split(F.upper(strip(F.col(text))), f"{SPACE}+")


def label(text: str) -> Column:
    """The first characters of a line, as its name in reports."""
    return F.substring(text, 1, LABEL_LENGTH)


# Every line carries this word and every list holds it without any score, so that a line
# keeps its row in an inner join, where all other unlisted words drop out early.
MARK = "\x00"


def _listed_words(
    lines: DataFrame, keys: list[str], text: str, lexicon: DataFrame, scores: list[str]
) -> DataFrame:
    """(keys, label, word, scores): the listed words of every line and its mark.

    The word list is broadcast when it is small, which ``lookup_join`` checks.
    """
    words = lines.select(
        *keys,
        label(text).alias("label"),
        F.explode(F.concat(F.array(F.lit(MARK)), tokens(text))).alias("word"),
    )
    listed = lexicon.select("word", *scores)
    marks = inline_table(lines.sparkSession, [(MARK,)], ["word"])
    return lookup_join(
        words, listed.unionByName(marks, allowMissingColumns=True), ["word"],
        spread_by=F.struct(*keys),
    )


def lexicon_counts(lines: DataFrame, keys: list[str], text: str, lexicon: DataFrame) -> DataFrame:
    """Words of each sentiment per line; a line without any keeps its row of zeros.

    All words of a line are in one task, so they are summed before the shuffle and a line
    costs one row there.
    """
    flags = lexicon.select("word", *[F.col(s).cast("int").alias(s) for s in SENTIMENTS])
    flags = flags.where(F.greatest(*SENTIMENTS) > 0)
    hits = _listed_words(lines, keys, text, flags, SENTIMENTS)
    sums = [F.sum(F.coalesce(s, F.lit(0))).alias(s) for s in SENTIMENTS]
    return hits.groupBy(*keys, "label").agg(*sums)


def lexicon_totals(counts: DataFrame, sentiments: list[str] = SENTIMENTS) -> DataFrame:
    """Sums over all lines."""
    return counts.agg(*[F.sum(s).alias(s) for s in sentiments])


def polarity(lines: DataFrame, keys: list[str], text: str, lexicon: DataFrame) -> DataFrame:
    """Mean polarity and subjectivity of the listed words per line, and |polarity|.

    ``lexicon`` has (word, polarity, subjectivity). A line without listed words scores 0.
    """
    hits = _listed_words(lines, keys, text, lexicon, ["polarity", "subjectivity"])
    scored = hits.groupBy(*keys, "label").agg(
        F.coalesce(F.avg("polarity"), F.lit(0.0)).alias("polarity"),
        F.coalesce(F.avg("subjectivity"), F.lit(0.0)).alias("subjectivity"),
    )
    return scored.withColumn("intensity", F.abs("polarity"))


def polarity_means(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.avg("polarity").alias("polarity"), F.avg("subjectivity").alias("subjectivity")
    )


def word_frequency(df: DataFrame, text: str, k: int) -> DataFrame:
    """The k most frequent words, counted map-side; ties in word order."""
    words = df.where(F.col(text).isNotNull()).select(F.explode(tokens(text)).alias("word"))
    counts = words.where(F.length("word") > 0).groupBy("word").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(k)

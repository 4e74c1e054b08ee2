"""Text lines and word lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slackline.fixed_values import SENTIMENTS
from slackline.schema import LEXICON_SCHEMA

# White space of any script: as a pattern, and as the characters themselves.
SPACE = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    map(chr, [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def split_lines(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, line_no, text): every non-blank line, stripped."""
    lines = df.select(
        *keys, F.posexplode(F.split(F.col(text), "\r\n|\n|\r")).alias("line_no", "text")
    )
    return lines.withColumn("text", strip(F.col("text"))).where(F.length("text") > 0)


def read_lines(spark: SparkSession, path: str, header: str) -> DataFrame:
    """(path, text): the non-blank lines of text files without their header line.

    Only the first line of a file can be its header; later lines equal to it are answers.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), strip(F.col("value")).alias("text"),
        F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line"),
    )
    # The first line of a file is the smallest number in its first block.
    suspects = lines.where((F.col("_start") == 0) & (F.col("text") == header))
    heads = lines.where("_start = 0").groupBy("path").agg(F.min("_line").alias("_line"))
    heads = heads.join(suspects.select("path", "_line"), ["path", "_line"], "left_semi")
    kept = lines.where((F.length("text") > 0) & (F.col("text") != header)).select("path", "text", "_line")
    again = suspects.join(heads, ["path", "_line"], "left_anti").select("path", "text", "_line")
    return kept.unionByName(again).select("path", "text")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A word list with one boolean per sentiment; rows without a word are skipped."""
    raw = spark.read.schema(LEXICON_SCHEMA).option("header", True).csv(path)
    return lexicon_flags(raw)


def lexicon_flags(raw: DataFrame) -> DataFrame:
    """(word, one flag per sentiment) of raw list rows: empty is 0, a flag is a count > 0."""
    words = raw.where(F.length("word") > 0)
    counts = [
        F.max(F.coalesce(F.nullif(F.trim(c), F.lit("")).cast("int"), F.lit(0)) > 0).alias(c)
        for c in SENTIMENTS
    ]
    # A word listed twice keeps the flags of both rows, so that a token matches once.
    return words.groupBy(F.upper("word").alias("word")).agg(*counts)


def lexicon_long(lexicon: DataFrame) -> DataFrame:
    """(word, sentiment) pairs of the set flags."""
    flagged = lexicon.unpivot(["word"], SENTIMENTS, "sentiment", "flag")
    return flagged.where("flag").select("word", "sentiment").distinct()

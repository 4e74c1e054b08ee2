"""Records of delimited files of any size; a record may span lines inside quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slackline.functions.joins import lookup_join
from slackline.session import stored
from slackline.sources.cells import opens, split_cells, stays_open

UNDECODABLE = "undecodable text"
UNCLOSED = "unclosed quote"
MORE_CELLS = "more cells than the header"
FEWER_CELLS = "fewer cells than the header"


def read_records(
    spark: SparkSession, path: str | list[str], separator: str = ",", pattern: str | None = None, recursive: bool = False
) -> DataFrame:
    """(path, record_no from 0, record) of all files at ``path``, blank lines included.

    A file of no bytes has no record; Spark does not list it.

    Files are read in blocks as lines. Every line says whether a quoted cell is open at its end,
    once for either state at its beginning. A line for which both answers are equal fixes the
    state, other lines keep or swap it, so windows over a block's lines and over a file's few
    blocks give the state at every line; no task needs a whole file. Lines of one record are
    joined by a line feed. A quote that nothing closes to the end of its file joins nothing: the
    lines from there on are records of their own.
    """
    options = {"recursiveFileLookup": recursive} | ({"pathGlobFilter": pattern} if pattern else {})
    lines = spark.read.options(**options).text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    # A byte order mark is no part of the first cell.
    plain = F.when((F.col("block") == 0) & F.col("value").startswith("﻿"), F.substring("value", 2, 1 << 30)).otherwise(F.col("value"))
    lines = lines.withColumn("value", plain).withColumns({"to0": opens(F.col("value"), separator), "to1": stays_open(F.col("value"), separator)})
    fixes, swaps = F.col("to0") == F.col("to1"), (F.col("to0") & ~F.col("to1")).cast("int")
    inside = Window.partitionBy("path", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("swaps", F.coalesce(F.sum(swaps).over(inside), F.lit(0)))
    fixed = F.when(fixes, F.struct(F.col("to0").cast("int").alias("state"), "swaps"))
    lines = lines.withColumn("fixed", fixed).withColumn("last", F.last("fixed", ignorenulls=True).over(inside))
    known = (F.col("last.state") + F.col("swaps") - F.col("last.swaps")) % 2
    lines = stored(
        lines.select("path", "block", "id", "value", "fixed", "swaps", swaps.alias("swap"), known.alias("known"))
    )
    # The state at the beginning of every block.
    late = F.max_by("fixed", F.when(F.col("fixed").isNotNull(), F.col("id")))
    blocks = lines.groupBy("path", "block").agg(late.alias("late"), F.sum("swap").alias("total"))
    after = (F.col("late.state") + F.col("total") - F.col("late.swaps")) % 2
    blocks = blocks.select("path", "block", after.alias("after"), (F.col("total") % 2).alias("parity"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turned = F.sum(F.when(F.col("after").isNull(), F.col("parity")).otherwise(0)).over(earlier)
    blocks = blocks.withColumn("turned", F.coalesce(turned, F.lit(0)))
    mark = F.when(F.col("after").isNotNull(), F.struct(F.col("after").alias("state"), "turned"))
    blocks = blocks.withColumn("mark", mark).withColumn("last", F.last("mark", ignorenulls=True).over(earlier))
    start = F.coalesce((F.col("last.state") + F.col("turned") - F.col("last.turned")) % 2, F.col("turned") % 2)
    lines = lookup_join(lines, stored(blocks.select("path", "block", start.alias("start"))), ["path", "block"])
    state = F.coalesce("known", (F.col("start") + F.col("swaps")) % 2)
    lines = stored(lines.select("path", "block", "id", "value", (state == 0).alias("begins"), "swap", "fixed", state.alias("state")))
    # The record of every line, and the one that is still open at the end of a file.
    begun = F.max(F.when(F.col("begins"), F.col("id")))
    end = F.max_by(F.coalesce("fixed.state", (F.col("state") + F.col("swap")) % 2), F.struct("block", "id"))
    ends = lines.groupBy("path").agg(end.alias("end"), F.max_by("id", F.when(F.col("begins"), F.struct("block", "id"))).alias("open"))
    ends = stored(ends.where("end = 1").select("path", "open"))
    heads = stored(
        lines.groupBy("path", "block").agg(begun.alias("begun"))
        .withColumn("carried", F.last("begun", ignorenulls=True).over(earlier)).select("path", "block", "carried")
    )
    lines = lookup_join(lookup_join(lines, heads, ["path", "block"]), ends, ["path"], "left")
    here = F.last(F.when(F.col("begins"), F.col("id")), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    lines = lines.withColumn("record", F.coalesce(here, F.col("carried")))
    lines = lines.withColumn("alone", F.coalesce(F.col("record") == F.col("open"), F.lit(False)))
    lines = stored(
        lines.select("path", "block", "id", "value", F.when(F.col("alone"), F.col("id")).otherwise(F.col("record")).alias("record"))
    )
    first = F.col("record") == F.col("id")
    more = lines.where(~first)
    several = stored(more.select("path", "record").distinct())
    parts = lookup_join(lines, several, ["path", "record"], "left_semi")
    joined = parts.groupBy("path", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "id", "value"))), lambda x: x["value"]), "\n").alias("whole")
    )
    counts = lines.where(first).groupBy("path", "block").agg(F.count("*").alias("n"))
    counts = counts.select("path", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("path", "block").orderBy("id")) - 1
    numbered = lookup_join(lines.where(first).withColumn("place", place), stored(counts), ["path", "block"])
    whole = lookup_join(numbered, stored(joined), ["path", "record"], "left")
    return whole.select(
        "path", (F.col("before") + F.col("place")).cast("long").alias("record_no"), F.coalesce("whole", "value").alias("record")
    )


def read_table(
    spark: SparkSession,
    path: str | list[str],
    separator: str = ",",
    pattern: str | None = None,
    short_rows: str = "reject",
) -> tuple[DataFrame, DataFrame]:
    """(heads, rows) of files whose record 0 is a header.

    ``heads`` (path, header) has the trimmed labels of every file with any content. ``rows``
    (path, record_no, record, header, cells, reason) has every further record that is not blank.
    ``reason`` is NULL for a good row; others are undecodable, have an unclosed quote, or more or
    fewer cells than the header. ``short_rows="keep"`` takes missing cells at the end as NULL.
    """
    if short_rows not in ("reject", "keep"):
        raise ValueError(f"unknown choice for short rows: {short_rows}")
    records = stored(read_records(spark, path, separator, pattern))
    heads = stored(
        records.where("record_no = 0").select("path", F.transform(split_cells(F.col("record"), separator), lambda c: F.trim(c)).alias("header"))
    )
    body = records.where(F.trim("record") != "").where("record_no > 0").withColumn("cells", split_cells(F.col("record"), separator))
    rows = lookup_join(body, heads, ["path"])
    many, few = F.size("cells") > F.size("header"), F.size("cells") < F.size("header")
    reason = (
        F.when(~F.is_valid_utf8("record"), UNDECODABLE)
        .when(opens(F.col("record"), separator), UNCLOSED)
        .when(many, MORE_CELLS)
        .when(few & F.lit(short_rows == "reject"), FEWER_CELLS)
    )
    return heads, rows.select("path", "record_no", "record", "header", "cells", reason.alias("reason"))


def cell(name: str) -> Column:
    """The cell of a row of ``read_table`` under the first label ``name``; NULL if empty or without."""
    at = F.array_position("header", F.lit(name)).cast("int")
    return F.when(at > 0, F.nullif(F.get("cells", at - 1), F.lit("")))


def malformed(rows: DataFrame) -> DataFrame:
    """(path, record_no, reason, record) of the rows that were not taken."""
    return rows.where("reason IS NOT NULL").select("path", "record_no", "reason", "record")

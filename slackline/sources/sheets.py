"""Sheet exports: one text file per sheet, the sheet name as the file name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slackline.fixed_values import (
    ACCOUNT_LABEL,
    HEADER_ROW,
    NAME_LABELS,
    NEW_LAYOUT_YEAR,
    REF_LABEL,
    SHEET_NAME,
    ZERO_LABEL,
)
from slackline.functions.joins import lookup_join
from slackline.sources.cells import bind, split_cells
from slackline.sources.records import read_records

FILE_NAME = r"([^/]+)\.[^./]*$"
HRM1, HRM2_OLD, HRM2_NEW = "HRM1", "HRM2_TO_2018", "HRM2_FROM_2019"


def read_sheets(
    spark: SparkSession, path: str, pattern: str = "*.csv", separator: str = ",", name: str = FILE_NAME
) -> DataFrame:
    """(path, sheet, line_no, line) of every matching file below ``path``; blank lines count.

    ``path`` of a row is the file's place below the input folder, so that digits above it
    are no year, and ``sheet`` what ``name`` finds in it, by default the file's name. A line
    break inside a quoted cell does not end a line. Files are read in blocks, whatever their size.
    """
    records = read_records(spark, path, separator, pattern, recursive=True)
    plain = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    root = F.lit(path.rstrip("/").split("://")[-1].removeprefix("file:"))
    place = F.instr(plain, root)
    below = F.when(place > 0, F.substring(plain, place + F.length(root), F.length(plain))).otherwise(plain)
    return records.select(
        below.alias("path"), F.regexp_extract(plain, name, 1).alias("sheet"), F.col("record_no").alias("line_no"),
        F.col("record").alias("line"),
    )


def year_of_path(path: str | Column) -> Column:
    """The first four digits in a row anywhere in the path; NULL without."""
    return F.nullif(F.regexp_extract(path, r"\d{4}", 0), F.lit("")).cast("int")


def parse_sheets(sheets: DataFrame) -> DataFrame:
    """Add year, standard, region, layout and ``reason`` (NULL for a usable sheet)."""
    def group(i: int) -> Column:
        return F.nullif(F.regexp_extract("sheet", SHEET_NAME, i), F.lit(""))

    named = sheets.select(
        "*",
        year_of_path(F.col("path")).alias("year"),
        F.coalesce(group(1), group(4)).alias("standard"),
        F.coalesce(group(2), group(3)).alias("region"),
    )
    layout = (
        F.when(F.col("standard") == "HRM1", HRM1)
        .when((F.col("standard") == "HRM2") & (F.col("year") >= NEW_LAYOUT_YEAR), HRM2_NEW)
        .when((F.col("standard") == "HRM2") & (F.col("year") < NEW_LAYOUT_YEAR), HRM2_OLD)
    )
    sheet = F.col("sheet")
    reason = (
        F.when(~sheet.contains("HRM") | F.lower(sheet).contains("alle"), "not a region sheet")
        .when(F.col("standard").isNull(), "invalid sheet name")
        .when(F.col("year").isNull(), "no year in path")
        .when(layout.isNull(), "unknown standard")
    )
    return named.withColumn("layout", layout).withColumn("reason", reason)


def header_positions(cells: Column, layout: Column, year: Column) -> Column:
    """1-based position of each wanted column, by layout and occurrence of the label."""

    def body(labels: Column) -> Column:
        def at(label: Column | str, occurrence: int = 1) -> Column:
            text = F.lit(label) if isinstance(label, str) else label.cast("string")
            places = F.transform(labels, lambda c, i: F.when(c == text, i + 1))
            return F.get(F.array_compact(places), F.lit(occurrence - 1))

        def name_in(which: str) -> Column:
            return F.coalesce(*[at(x) for x in NAME_LABELS[which]])

        first_blank = F.get(labels, F.lit(0)) == ""
        second_blank = first_blank & (F.get(labels, F.lit(1)) == "")
        new, older = layout == HRM2_NEW, layout == HRM2_OLD
        account = F.when(new, at(ACCOUNT_LABEL)).when(first_blank, F.lit(1)).when(
            ~older, at(ZERO_LABEL)
        )
        name = (
            F.when(new, name_in(HRM2_NEW))
            .when(older, name_in(HRM2_OLD))
            .when(first_blank, F.when(second_blank, F.lit(2)))
            .otherwise(at(ZERO_LABEL, 2))
        )
        return F.struct(
            F.when(new, at(REF_LABEL)).alias("ref_id"),
            account.alias("acc_id"),
            name.alias("name"),
            at(year).alias("budget"),
            F.coalesce(F.when(new, at(year, 4)), at(year, 2)).alias("realized"),
            at(year + 1).alias("budget_next"),
        )

    return bind(cells, body)


def located_sheets(lines: DataFrame, separator: str = ",") -> DataFrame:
    """A row per sheet of ``lines``, with its header row resolved to column positions.

    Only the lines up to the lowest header row of any layout are gathered per sheet.
    """
    top = lines.where(F.col("line_no") <= max(HEADER_ROW.values()))
    sheets = top.groupBy("path", "sheet").agg(
        F.map_from_entries(F.collect_list(F.struct("line_no", "line"))).alias("top")
    )
    row = F.coalesce(
        *[F.when(F.col("layout") == k, F.lit(v)) for k, v in HEADER_ROW.items()]
    )
    parsed = parse_sheets(sheets).withColumn("header_row", row)
    header = split_cells(F.try_element_at("top", F.col("header_row").cast("long")), separator)
    at = bind(header, lambda cells: header_positions(cells, F.col("layout"), F.col("year")))
    located = parsed.withColumn("at", at).drop("top")
    needed = ["acc_id", "budget", "realized", "budget_next"]
    missing = F.concat_ws(", ", *[F.when(F.col(f"at.{c}").isNull(), F.lit(c)) for c in needed])
    return located.withColumn(
        "reason",
        F.coalesce(
            F.col("reason"),
            F.when(missing != "", F.concat(F.lit("no column for "), missing)),
            F.when((F.col("layout") == HRM2_NEW) & F.col("at.ref_id").isNull(), "no column for ref_id"),
        ),
    )


def sheet_rows(lines: DataFrame, located: DataFrame, separator: str = ",") -> DataFrame:
    """Text cells of all usable sheets; the row right after the header is not data."""
    usable = located.where("reason IS NULL")
    data = lookup_join(lines, usable, ["path", "sheet"]).where(F.col("line_no") > F.col("header_row") + 1)
    wanted = ["ref_id", "acc_id", "name", "budget", "realized", "budget_next"]

    def record(cells: Column) -> Column:
        return F.struct(
            *[F.nullif(F.get(cells, F.col(f"at.{c}") - 1), F.lit("")).alias(c) for c in wanted]
        )

    # The one-element explode keeps Catalyst from splitting a line again per column.
    records = F.array(bind(split_cells(F.col("line"), separator), record))
    return data.select("path", "sheet", "standard", "layout", "region", "year", F.inline(records))


def rejected(located: DataFrame) -> DataFrame:
    """(path, sheet, reason) of the sheets that were not read."""
    return located.where("reason IS NOT NULL").select("path", "sheet", "reason")

"""CSV panels, survey exports and score files; Parquet and CSV sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slackline.functions.numbers import to_number
from slackline.schema import (
    FINAL_COLUMNS,
    LEXICON_RESULT_SCHEMA,
    PANEL_HEADERS,
    PANEL_TYPES,
    POLARITY_RESULT_SCHEMA,
)
from slackline.sources.records import cell, malformed, read_table

HEADER_NAMES = {name: header for header, name in PANEL_HEADERS.items()}


def list_files(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """(path, length, usable): files below ``directory``; only names are read, no content."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory)
    )
    glob = pattern.replace(".", r"\.").replace("*", "[^/]*")
    return files.select("path", "length").withColumn("usable", F.col("path").rlike(f"{glob}$"))


def read_union_by_name(
    spark: SparkSession, directory: str, pattern: str, short_rows: str = "reject"
) -> tuple[DataFrame, DataFrame]:
    """(panel, rejects): all files of one name pattern, matched by column name.

    Every row carries the header of its file, so files of any layouts are one read, and neither
    headers nor paths reach the driver. A column a file lacks is NULL, a column of another label
    is ignored. ``rejects`` (path, record_no, reason, record) has the files without a known label,
    with the number 0, and every malformed row; with the panel's rows and the blank lines they are
    all there is.
    """
    heads, rows = read_table(spark, directory, pattern=pattern, short_rows=short_rows)
    known = F.exists("header", lambda c: c.isin(list(PANEL_HEADERS)))
    blank = F.forall("header", lambda c: c == "")
    files = heads.where(~known).select(
        "path", F.lit(0).cast("long").alias("record_no"), F.when(blank, "empty file").otherwise("unknown columns").alias("reason"),
        F.lit(None).cast("string").alias("record"),
    )
    rows = rows.where(known)

    def column(name: str) -> Column:
        text = cell(HEADER_NAMES[name])
        return to_number(text) if PANEL_TYPES[name] == "double" else text

    panel = rows.where("reason IS NULL").select(*[column(n).alias(n) for n in PANEL_TYPES])
    return panel, files.unionByName(malformed(rows))


def write_panel(df: DataFrame, path: str) -> None:
    """Parquet, one folder per year, so that a year is read without the others."""
    df.write.mode("overwrite").partitionBy("year").parquet(path)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _checked(spark: SparkSession, path: str, labels: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of files that must have all ``labels`` in their header."""
    heads, rows = read_table(spark, path)
    lacks = heads.where(F.size(F.array_except(F.array(*[F.lit(x) for x in labels]), F.col("header"))) > 0).first()
    if lacks is not None:
        raise ValueError(f"CSV header of {lacks['path']} lacks one of {labels}: {lacks['header']}")
    return rows.where("reason IS NULL"), malformed(rows)


def read_panel_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(panel, rejects) of a final panel in CSV with its published headers; others raise.

    A cell that is no number is NULL; malformed rows are rejects.
    """
    types = PANEL_TYPES | {"year": "int", "acc_id": "int"}
    rows, rejects = _checked(spark, path, [HEADER_NAMES[c] for c in FINAL_COLUMNS])
    return rows.select(*[cell(HEADER_NAMES[c]).try_cast(types[c]).alias(c) for c in FINAL_COLUMNS]), rejects


def write_panel_csv(df: DataFrame, path: str) -> None:
    """CSV with the headers of the yearly files."""
    named = df.select(*[F.col(c).alias(HEADER_NAMES.get(c, c)) for c in df.columns])
    named.write.mode("overwrite").option("header", True).csv(path)


def write_predictions(
    df: DataFrame, path: str, model: str, category: str | None, acc_id=None, region=None
) -> None:
    """Actual, prediction and budget per key, stored under the run that made them."""
    run = {"model": model, "category": category, "slice_acc_id": acc_id, "slice_region": region}
    rows = df.select("region", "acc_id", "year", "realized", "prediction", "budget")
    _write_run(rows, path, run)


def write_metrics(df: DataFrame, path: str, model: str, category: str | None, acc_id=None, region=None) -> None:
    """(metric, value) rows, stored under the run that made them."""
    run = {"model": model, "category": category, "slice_acc_id": acc_id, "slice_region": region}
    _write_run(df, path, run)


def _write_run(df: DataFrame, path: str, run: dict) -> None:
    # A rerun replaces its own folder only.
    named = df.withColumns({k: F.lit("all" if v is None else str(v)) for k, v in run.items()})
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *run
    ).parquet(path)


def write_trials(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_survey(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(answers, rejects) of a survey or demographics export, all cells as text.

    Answers may span lines. Further columns are ignored, a missing one raises.
    """
    rows, rejects = _checked(spark, path, columns)
    return rows.select(*[cell(c).alias(c) for c in columns]), rejects


def write_answers(df: DataFrame, column: str, path: str) -> None:
    """One answer per line under the column name, tab-separated."""
    df.select(column).write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def read_lexicon_result(spark: SparkSession, path: str) -> DataFrame:
    return _read_result(spark, path, LEXICON_RESULT_SCHEMA)


def read_polarity_result(spark: SparkSession, path: str) -> DataFrame:
    return _read_result(spark, path, POLARITY_RESULT_SCHEMA)


def _read_result(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def write_result(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)

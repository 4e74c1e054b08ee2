"""Column names, explicit schemas and the small tables built from fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slackline.fixed_values import CATEGORIES, CROSSWALK

AMOUNTS = ["budget", "realized", "budget_next"]
SERIES = ["region", "acc_id"]
KEYS = ["region", "acc_id", "year"]

# CSV header <-> column name.
PANEL_HEADERS = {
    "Ref-ID": "ref_id",
    "Acc-ID": "acc_id",
    "Name": "name",
    "Budget y": "budget",
    "Realized": "realized",
    "Budget y+1": "budget_next",
    "Region": "region",
    "Year": "year",
    "Slack": "slack",
}

PANEL_TYPES = {
    "ref_id": "string",
    "acc_id": "string",
    "name": "string",
    "budget": "double",
    "realized": "double",
    "budget_next": "double",
    "region": "string",
    "year": "string",
    "slack": "double",
}

FINAL_COLUMNS = ["year", "region", "acc_id", "realized", "budget", "budget_next", "slack"]

LEXICON_SCHEMA = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("sequence", T.StringType()),
        T.StructField("word_count", T.StringType()),
        T.StructField("proportion", T.StringType()),
        T.StructField("average_proportion", T.StringType()),
        T.StructField("std_dev", T.StringType()),
        T.StructField("doc_count", T.StringType()),
        T.StructField("negative", T.StringType()),
        T.StructField("positive", T.StringType()),
        T.StructField("uncertainty", T.StringType()),
        T.StructField("litigious", T.StringType()),
        T.StructField("strong_modal", T.StringType()),
        T.StructField("weak_modal", T.StringType()),
        T.StructField("constraining", T.StringType()),
        T.StructField("syllables", T.StringType()),
        T.StructField("source", T.StringType()),
    ]
)

LEXICON_RESULT_SCHEMA = (
    "Text string, negative int, positive int, uncertainty int, litigious int, "
    "strong_modal int, weak_modal int, constraining int"
)
POLARITY_RESULT_SCHEMA = "Text string, Polarity double, Subjectivity double, Intensity double"


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Return ``df`` or raise when one of ``columns`` is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline_table(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A table of constants that Catalyst sees with its true size. Without rows its columns
    have no type."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).alias(c) for c in columns])
    values = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def category_dim(spark: SparkSession) -> DataFrame:
    """(category, acc_id) for every account group."""
    rows = [(name, acc) for name, accounts in CATEGORIES.items() for acc in accounts]
    return inline_table(spark, rows, ["category", "acc_id"])


def crosswalk_dim(spark: SparkSession) -> DataFrame:
    """(old_acc, new_acc, ratio); the ratios of one old account sum to one."""
    rows = [
        (old, new, 1.0 / len(targets)) for old, targets in CROSSWALK.items() for new in targets
    ]
    return inline_table(spark, rows, ["old_acc", "new_acc", "ratio"])

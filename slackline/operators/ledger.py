"""From account rows of both standards to one uniform panel."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slackline.fixed_values import DEFAULT_NAME, DEFAULT_REF_ID
from slackline.functions.joins import lookup_join
from slackline.functions.numbers import exact_sum, is_zero, to_number
from slackline.schema import AMOUNTS, FINAL_COLUMNS, crosswalk_dim, require_columns
from slackline.session import stored


def apply_crosswalk(
    df: DataFrame, amounts: list[str] | None = None, aggregate: bool = False
) -> DataFrame:
    """Old accounts to new ones; a range account is split evenly over its new accounts.

    Unknown accounts pass unchanged. Several old accounts can lead to one new account:
    ``aggregate`` sums those rows, otherwise they stay side by side.
    """
    amounts = amounts or [c for c in AMOUNTS if c in df.columns]
    dim = crosswalk_dim(df.sparkSession)
    joined = df.join(F.broadcast(dim), F.col("acc_id") == F.col("old_acc"), "left")
    ratio = F.coalesce("ratio", F.lit(1.0))
    new = {"acc_id": F.coalesce("new_acc", "acc_id")} | {c: F.col(c) * ratio for c in amounts}
    split = joined.select(*[new.get(c, F.col(c)).alias(c) for c in df.columns])
    if not aggregate:
        return split
    keys = [c for c in df.columns if c not in amounts]
    return split.groupBy(*keys).agg(*[exact_sum(c).alias(c) for c in amounts]).select(*df.columns)


def keep_numeric_accounts(df: DataFrame, drop_zero: bool = False) -> DataFrame:
    """Rows whose account is digits only; the old standard also drops account 0."""
    rows = df.where(F.col("acc_id").rlike("^[0-9]+$"))
    return rows.where("acc_id <> '0'") if drop_zero else rows


def keep_referenced(df: DataFrame) -> DataFrame:
    """Rows whose reference id names the standard; a missing id does not."""
    return df.where(F.coalesce("ref_id", F.lit("")).contains("HRM"))


def with_slack(df: DataFrame) -> DataFrame:
    """Budget minus realized, zero without a budget. Unknown amounts give NULL."""
    slack = F.when(is_zero("budget"), F.lit(0.0)).otherwise(F.col("budget") - F.col("realized"))
    return df.withColumn("slack", slack)


def numbers_or_null(df: DataFrame, amounts: list[str] | None = None) -> DataFrame:
    """Amount cells as numbers; text, blank and missing cells become NULL."""
    amounts = amounts or [c for c in AMOUNTS if c in df.columns]
    return df.withColumns({c: to_number(c) for c in amounts})


def zeros_for_null(df: DataFrame, amounts: list[str] | None = None) -> DataFrame:
    """Missing amounts as zero."""
    amounts = amounts or [c for c in [*AMOUNTS, "slack"] if c in df.columns]
    return df.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in amounts})


def with_level(df: DataFrame) -> DataFrame:
    """Number of digits of the account; 1 and 2 are the two panels."""
    return df.withColumn("level", F.length("acc_id"))


def clean_rows(rows: DataFrame) -> DataFrame:
    """Text rows of all sheets to clean ledger rows, each layout by its own rules.

    One pass over the rows: the rules of the layouts are conditions, not branches.
    """
    require_columns(rows, ["layout", "region", "year", "ref_id", "acc_id", "name", *AMOUNTS])
    old, new = F.col("layout") == "HRM1", F.col("layout") == "HRM2_FROM_2019"
    numbers = numbers_or_null(rows)
    # Only the old standard is mapped: other rows get a key that no mapping has.
    keyed = numbers.withColumn("_key", F.when(old, F.col("acc_id")))
    dim = crosswalk_dim(rows.sparkSession)
    joined = keyed.join(F.broadcast(dim), F.col("_key") == F.col("old_acc"), "left")
    ratio = F.coalesce("ratio", F.lit(1.0))
    mapped = joined.withColumns(
        {"acc_id": F.coalesce("new_acc", "acc_id")} | {c: F.col(c) * ratio for c in AMOUNTS}
    ).select(*rows.columns)
    kept = keep_numeric_accounts(mapped).where(
        (~old | (F.col("acc_id") != "0"))
        & (~new | F.coalesce("ref_id", F.lit("")).contains("HRM"))
    )
    return with_level(zeros_for_null(with_slack(kept)))


def populated(df: DataFrame, keys: list[str], amounts: tuple[str, ...] = ("realized", "budget")) -> DataFrame:
    """(keys, populated): some amount of the one- or the two-digit rows does not sum to zero."""
    levels = [F.length("acc_id") == n for n in (1, 2)]
    sums = [exact_sum(F.when(level, F.col(a))) for level in levels for a in amounts]
    return df.groupBy(*keys).agg(
        reduce(or_, [F.coalesce(s != 0, F.lit(False)) for s in sums]).alias("populated")
    )


def prefer_standard(
    df: DataFrame, mode: str = "prefer", scope: tuple[str, ...] = ("year", "region")
) -> DataFrame:
    """One accounting standard per workbook and region.

    ``prefer``: the new standard where both exist, unless it holds no amounts.
    ``keep_all``: the rows of both standards, as in the published panels.
    """
    if mode == "keep_all":
        return df
    if mode != "prefer":
        raise ValueError(f"unknown mode: {mode}")
    is_new = F.col("standard") == "HRM2"
    state = populated(df, [*scope, "standard"])
    # One row per region and year. It is stored so that its size is known: the ledger
    # rows then meet it without a shuffle, and without sorting a large region into one task.
    use_new = F.bool_or(is_new & F.col("populated")) | ~F.bool_or(~is_new)
    chosen = stored(
        state.groupBy(*scope).agg(F.when(use_new, "HRM2").otherwise("HRM1").alias("standard"))
    )
    keys = [*scope, "standard"]
    return lookup_join(df, chosen, keys, "left_semi", spread_by=F.col("acc_id")).select(*df.columns)


def sum_collisions(df: DataFrame, keys: tuple[str, ...] = ("year", "region", "standard", "acc_id")) -> DataFrame:
    """One row per key: amounts summed, of other columns the smallest value.

    Old accounts that the crosswalk maps to the same new one collide, as do lines that a
    sheet splits. A key present once keeps its row as it is. Slack is taken of the sums.
    """
    keys = [k for k in keys if k in df.columns]
    amounts = [c for c in AMOUNTS if c in df.columns]
    other = [c for c in df.columns if c not in {*keys, *amounts, "slack"}]
    summed = df.groupBy(*keys).agg(
        *[exact_sum(c).alias(c) for c in amounts], *[F.min(c).alias(c) for c in other]
    )
    return (with_slack(summed) if "slack" in df.columns else summed).select(*df.columns)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Defaults for the reference id and the name."""
    return df.fillna({"ref_id": DEFAULT_REF_ID, "name": DEFAULT_NAME})


def typed(df: DataFrame) -> DataFrame:
    """Account and year as integers; a year without four digits raises."""
    year = F.col("year").cast("string")
    checked = F.when(year.rlike("^[0-9]{4}$"), year.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("not a year: "), F.coalesce(year, F.lit("NULL")))).cast("int")
    )
    return df.withColumns({"acc_id": F.col("acc_id").cast("int"), "year": checked})


def finalize(df: DataFrame) -> DataFrame:
    """Fill, convert and keep the columns of the final panel."""
    return typed(fill_defaults(df)).select(*FINAL_COLUMNS)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows, matched by column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

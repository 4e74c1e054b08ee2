"""The two-arm budgeting experiment: funnel, answers, groups and slack reduction."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slackline.fixed_values import (
    AGE_EDGES,
    AGE_LABELS,
    CHECK_RULES,
    CONSENT,
    EXPERIENCE_LABELS,
    FORECAST,
    FUNNEL_STEPS,
    SEX_LABELS,
    SEX_OTHER,
)
from slackline.functions.numbers import exact_sum, percent_of, scalar
from slackline.operators.explore import describe_series
from slackline.schema import inline_table


def passed_check(arm: str, answer: str, rules: dict[str, str] = CHECK_RULES) -> Column:
    """True when the answer is the one expected in its arm; unknown is false."""
    fits = [(F.col(arm) == a) & (F.col(answer) == expected) for a, expected in rules.items()]
    return F.coalesce(reduce(or_, fits), F.lit(False))


def completed(df: DataFrame, answer: str = "Manip_Check") -> DataFrame:
    """Responses that reached the manipulation check."""
    return df.where(F.col(answer).isNotNull())


def funnel(
    df: DataFrame,
    consent: str = "Consent",
    first: str = "Scenario1_Answer_1",
    check: str = "Manip_Check",
    arm: str = "FL_23_DO",
) -> DataFrame:
    """(step_no, step, participants, pct_change) of the four survey steps in one pass."""
    counts = df.agg(
        F.count_if(F.col(consent) == CONSENT).alias("c0"),
        F.count(first).alias("c1"),
        F.count(check).alias("c2"),
        F.count_if(passed_check(arm, check)).alias("c3"),
    )
    steps = []
    for i, step in enumerate(FUNNEL_STEPS):
        here = F.col(f"c{i}")
        if i == 0:
            change = F.lit(0.0)
        else:
            before = F.col(f"c{i - 1}")
            change = F.coalesce(percent_of(here - before, before), F.lit(0.0))
        steps.append(
            F.struct(
                F.lit(i + 1).alias("step_no"),
                F.lit(step).alias("step"),
                here.alias("participants"),
                change.alias("pct_change"),
            )
        )
    return counts.select(F.inline(F.array(*steps)))


def with_any_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Blank cells as NULL, rows without any of ``columns`` dropped."""
    blank = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})
    return blank.dropna(how="all", subset=columns)


def final_answer(again: list[str], first: str) -> Column:
    """The first resubmission present, else the first answer."""
    return F.coalesce(*again, first)


def arm_counts(df: DataFrame, arm: str, arms: list[str]) -> DataFrame:
    """Responses per arm, zero for an arm without any."""
    counts = df.groupBy(arm).agg(F.count("*").alias("n"))
    return _on_labels(counts, arm, arms, ["n"])


def _on_labels(counts: DataFrame, column: str, labels: list[str], values: list[str]) -> DataFrame:
    spark = counts.sparkSession
    dim = inline_table(spark, [(i, x) for i, x in enumerate(labels)], ["position", column])
    joined = dim.join(counts, column, "left")
    return joined.select(
        "position", column, *[F.coalesce(v, F.lit(0)).alias(v) for v in values]
    )


def arm_distribution(df: DataFrame, arm: str, arms: list[str], stages: dict[str, str]) -> DataFrame:
    """count, mean, std, median, min and max of each stage's answers in each arm."""
    series = {
        f"{a}|{stage}": F.when(F.col(arm) == a, F.col(column))
        for a in arms
        for stage, column in stages.items()
    }
    name = F.split("series", r"\|")
    return describe_series(df, series).select(
        F.get(name, F.lit(0)).alias("arm"),
        F.get(name, F.lit(1)).alias("stage"),
        "count",
        "mean",
        "std",
        F.col("q50").alias("median"),
        "min",
        "max",
    )


def resubmissions(
    df: DataFrame, arm: str, arms: list[str], first: str, again: str, digits: int = 2
) -> DataFrame:
    """(arm, n, resubmissions, rate_pct, mean_change); the rate of an empty arm is 0."""
    both = F.col(first).isNotNull() & F.col(again).isNotNull()
    counted = df.groupBy(arm).agg(
        F.count("*").alias("n"),
        F.count_if(both).alias("resubmissions"),
        exact_sum(F.when(both, F.col(again) - F.col(first))).alias("_change"),
    )
    dim = inline_table(df.sparkSession, [(a,) for a in arms], [arm])
    n, k = F.coalesce("n", F.lit(0)), F.coalesce("resubmissions", F.lit(0))
    return dim.join(counted, arm, "left").select(
        arm,
        n.alias("n"),
        k.alias("resubmissions"),
        F.bround(F.coalesce(percent_of(k, n), F.lit(0.0)), digits).alias("rate_pct"),
        F.bround(F.try_divide(F.col("_change"), k), digits).alias("mean_change"),
    )


def reduction_pivot(table: DataFrame, arm: str, arms: list[str], scenario: str) -> DataFrame:
    """Mean change with one column per arm and one row per scenario."""
    return (
        table.withColumn("scenario", F.lit(scenario))
        .groupBy("scenario")
        .pivot(arm, arms)
        .agg(F.first("mean_change"))
    )


def slack_reduction(
    df: DataFrame, first: str, final: str, forecast: float = FORECAST, relative: bool = False
) -> DataFrame:
    """Answers with slack left and no increase: ``slack``, ``reduction``, ``negative``.

    ``relative`` adds ``relative_reduction`` and keeps the rows where it is known.
    """
    rows = (
        df.withColumn("slack", F.col(final) - F.lit(forecast))
        .where("slack >= 0")
        .withColumn("reduction", F.col(first) - F.col(final))
        .where("reduction >= 0")
        .withColumn("negative", F.lit(0.0) - F.abs("reduction"))
    )
    if not relative:
        return rows
    share = F.try_divide(F.col("reduction"), F.col(first))
    return rows.withColumn("relative_reduction", share).where("relative_reduction >= 0")


def bucket(column: str, edges: list[float], labels: list[str]) -> Column:
    """Label of the half-open range that holds the value; the last range has no end."""
    value = F.col(column)
    label = F.when(value >= edges[-1], labels[-1])
    for low, high, name in zip(edges, edges[1:], labels):
        label = label.when((value >= low) & (value < high), name)
    return label


def age_group(column: str = "age") -> Column:
    return bucket(column, AGE_EDGES, AGE_LABELS)


def experience_class(column: str = "experience") -> Column:
    """Values between two classes, above ten and missing ones are all in the last class."""
    years = F.col(column)
    under, low, middle, rest = EXPERIENCE_LABELS
    return (
        F.when(years < 1, under).when(years.between(1, 5), low).when(years.between(6, 10), middle)
    ).otherwise(rest)


def sex_group(column: str = "sex") -> Column:
    return F.when(F.col(column).isin(SEX_OTHER), "Other").otherwise(F.col(column))


def shares_on_labels(df: DataFrame, group: Column, labels: list[str]) -> DataFrame:
    """(position, label, n, pct) for a fixed label list; an absent label counts 0."""
    counts = df.select(group.alias("label")).where("label IS NOT NULL").groupBy("label").agg(
        F.count("*").alias("n")
    )
    # The total stands beside the few counted labels, so the rows are read once.
    counts = counts.withColumn("_total", F.sum("n").over(Window.partitionBy(F.lit(0))))
    placed = _on_labels(counts, "label", labels, ["n", "_total"])
    total = F.max("_total").over(Window.partitionBy(F.lit(0)))
    return placed.withColumn("pct", F.coalesce(percent_of(F.col("n"), total), F.lit(0.0))).drop("_total")


def sex_shares(df: DataFrame, column: str = "sex") -> DataFrame:
    return shares_on_labels(df, sex_group(column), SEX_LABELS)


def participants_only(demographics: DataFrame, survey: DataFrame, key: str = "pid") -> DataFrame:
    """Demographics of the people who answered."""
    return demographics.join(survey.select(key), key, "left_semi")


def attach_demographics(
    survey: DataFrame, demographics: DataFrame, columns: list[str], key: str = "pid"
) -> DataFrame:
    """Survey rows with columns of the same person, matched by key.

    A person listed twice raises instead of doubling the answers.
    """
    listed = demographics.groupBy(key).agg(
        F.count("*").alias("_rows"), *[F.first(c).alias(c) for c in columns]
    )
    unique = F.when(F.col("_rows") == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit("a participant has several demographic rows")).cast("boolean")
    )
    return survey.join(listed.where(unique).drop("_rows"), key, "left")


def contingency(
    df: DataFrame, row: str, column: str, rows: list[str], columns: list[str]
) -> DataFrame:
    """Counts of row by column labels in the given order, 0 where nothing was seen."""
    counts = df.where(F.col(row).isin(rows)).groupBy(row).pivot(column, columns).count()
    return _on_labels(counts, row, rows, columns)

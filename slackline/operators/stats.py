"""Tests on aggregated rows, one per group: Welch, chi-square, effect sizes, moments."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slackline.functions.special import chi2_pvalue, t_pvalue


def arm_moments(df: DataFrame, arm: str, value: str) -> DataFrame:
    """count, mean, sample variance and std of the known values per arm."""
    return df.groupBy(arm).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.var_samp(value).alias("variance"),
        F.stddev_samp(value).alias("std"),
    )


def welch(
    df: DataFrame, arm: str, value: str, first: str, second: str, by: tuple[str, ...] = ()
) -> DataFrame:
    """Two-sided t-test without equal variances: one row with t, dof and p, or one per group.

    The data is aggregated once; an arm with fewer than two values gives NULL.
    """
    sides = {"1": first, "2": second}
    wide = []
    for s, label in sides.items():
        x = F.when(F.col(arm) == label, F.col(value).cast("double"))
        wide += [
            F.count(x).alias(f"n{s}"), F.avg(x).alias(f"mean{s}"), F.var_samp(x).alias(f"var{s}")
        ]
    a = F.try_divide(F.col("var1"), F.col("n1"))
    b = F.try_divide(F.col("var2"), F.col("n2"))
    t = F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(a + b))
    dof = F.try_divide(
        (a + b) * (a + b),
        F.try_divide(a * a, F.col("n1") - 1) + F.try_divide(b * b, F.col("n2") - 1),
    )
    tested = df.groupBy(*by).agg(*wide).withColumns({"t": t, "dof": dof})
    return tested.withColumn("p", t_pvalue("t", "dof"))


def count_cells(row: str, column: str, rows: list, columns: list) -> list[list[Column]]:
    """The cells of a contingency table as aggregates."""
    return [
        [F.count_if((F.col(row) == r) & (F.col(column) == c)) for c in columns] for r in rows
    ]


def chi_square(df: DataFrame, cells: list[list[Column]], by: tuple[str, ...] = ()) -> DataFrame:
    """Pearson chi-square of a table of aggregates: one row, or one per group.

    ``chi2`` and ``p`` are uncorrected. ``chi2_yates`` and ``p_yates`` move each count up
    to 0.5 towards its expectation, in tables with one degree of freedom only. ``expected``
    holds the expected counts row by row. ``cramers_v`` and ``phi`` use the uncorrected value.
    """
    rows, columns = len(cells), len(cells[0])
    names = [[f"o{i}_{j}" for j in range(columns)] for i in range(rows)]
    flat = [cells[i][j].alias(names[i][j]) for i in range(rows) for j in range(columns)]
    table = df.groupBy(*by).agg(*flat)
    row_sum = [reduce(add, [F.col(c) for c in r]) for r in names]
    column_sum = [reduce(add, [F.col(r[j]) for r in names]) for j in range(columns)]
    n = reduce(add, row_sum)
    dof = (rows - 1) * (columns - 1)
    plain, corrected, expected = [], [], []
    for i in range(rows):
        for j in range(columns):
            e = F.try_divide(row_sum[i].cast("double") * column_sum[j], n)
            gap = F.abs(F.col(names[i][j]) - e)
            moved = gap - F.least(gap, F.lit(0.5)) if dof == 1 else gap
            plain.append(F.try_divide(gap * gap, e))
            corrected.append(F.try_divide(moved * moved, e))
            expected.append(e)
    chi2, yates = reduce(add, plain), reduce(add, corrected)
    smaller = min(rows, columns) - 1
    tested = table.select(
        *by,
        n.alias("n"),
        F.lit(dof).alias("dof"),
        chi2.alias("chi2"),
        yates.alias("chi2_yates"),
        F.sqrt(F.try_divide(chi2, n * smaller)).alias("cramers_v"),
        F.sqrt(F.try_divide(chi2, n)).alias("phi"),
        F.array(*expected).alias("expected"),
    )
    return tested.withColumns(
        {"p": chi2_pvalue("chi2", "dof"), "p_yates": chi2_pvalue("chi2_yates", "dof")}
    )


def moments(df: DataFrame, column: str, by: tuple[str, ...] = ()) -> DataFrame:
    """n, mean, sample std, population skewness and excess kurtosis."""
    return df.groupBy(*by).agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.skewness(column).alias("skewness"),
        F.kurtosis(column).alias("kurtosis"),
    )


def normal_curve(df: DataFrame, column: str, points: int = 100, margin: float = 0.05) -> DataFrame:
    """(point, x, density): the fitted normal density over the plotted range.

    ``margin`` is the share of the value range that the axis shows on either side.
    """
    value = F.col(column).cast("double")
    fit = df.agg(
        F.struct(
            F.min(value).alias("lo"),
            F.max(value).alias("hi"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
        )
    ).scalar()
    pad = (fit["hi"] - fit["lo"]) * margin
    low, high = fit["lo"] - pad, fit["hi"] + pad
    x = low + F.col("id") * (high - low) / (points - 1)
    z = F.try_divide(F.col("x") - fit["mean"], fit["std"])
    density = F.try_divide(F.exp(-z * z / 2), fit["std"] * F.sqrt(F.lit(2.0) * F.pi()))
    return (
        df.sparkSession.range(points)
        .select(F.col("id").alias("point"), x.alias("x"))
        .withColumn("density", density)
    )

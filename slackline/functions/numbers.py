"""Number expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(column: str | Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL.

    The pattern guards the cast, which alone would accept suffixes such as ``1d``.
    """
    text = F.col(column) if isinstance(column, str) else column
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def is_zero(column: str | Column) -> Column:
    """Null-safe test for zero: NULL is not zero."""
    value = F.col(column) if isinstance(column, str) else column
    return value.eqNullSafe(F.lit(0.0))


def exact_sum(column: str | Column) -> Column:
    """Sum that does not depend on the order of the rows."""
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(value.cast(MONEY)).cast("double")


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL for a zero whole."""
    return F.try_divide(part * F.lit(100.0), whole)


def scalar(df: DataFrame, expression: Column) -> Column:
    """One aggregate of ``df`` as a scalar subquery."""
    return df.agg(expression.alias("v")).scalar()

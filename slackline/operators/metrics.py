"""Forecast errors, for one frame or for every slice of it in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Smallest divisor of the relative error.
EPSILON = 2.220446049250313e-16


def error_aggregates(
    actual: str, forecast: str, prefix: str = "", rounded: bool = False
) -> list[Column]:
    """n, MAE, MSE, RMSE, MAPE and the MAPE over rows with a non-zero actual.

    ``rounded`` gives two decimals, with the root taken of the rounded square error.
    """
    y, f = F.col(actual).cast("double"), F.col(forecast).cast("double")
    miss = F.abs(y - f)
    mae, mse = F.avg(miss), F.avg(miss * miss)
    mape = F.avg(miss / F.greatest(F.abs(y), F.lit(EPSILON)))
    nonzero = F.avg(F.when(y != 0, miss / F.abs(y)))
    if rounded:
        mae, mse, mape, nonzero = (F.bround(m, 2) for m in (mae, mse, mape, nonzero))
    rmse = F.sqrt(mse)
    if rounded:
        rmse = F.bround(rmse, 2)
    named = {"n": F.count(miss), "mae": mae, "mse": mse, "rmse": rmse, "mape": mape,
             "mape_nonzero": nonzero}
    return [column.alias(prefix + name) for name, column in named.items()]


def evaluate(
    df: DataFrame, actual: str, forecast: str, by: tuple[str, ...] = (), rounded: bool = False
) -> DataFrame:
    """Errors of one forecast column, optionally per group."""
    return df.groupBy(*by).agg(*error_aggregates(actual, forecast, rounded=rounded))


def _long(df: DataFrame, actual: str, forecasts: list[str], keep: list[str]) -> DataFrame:
    """One row per forecast column, so that all of them share one aggregation."""
    return df.unpivot([*keep, actual], forecasts, "forecast", "predicted")


def compare(
    df: DataFrame, actual: str, forecasts: list[str], by: tuple[str, ...] = (), rounded: bool = False
) -> DataFrame:
    """Errors of several forecast columns side by side, one row per column (and group)."""
    rows = _long(df, actual, forecasts, list(by))
    return rows.groupBy("forecast", *by).agg(
        *error_aggregates(actual, "predicted", rounded=rounded)
    )


def compare_slices(df: DataFrame, actual: str, forecasts: list[str], rounded: bool = False) -> DataFrame:
    """``compare`` for all rows, each account, each region and each pair in one pass."""
    rows = _long(df, actual, forecasts, ["region", "acc_id"])
    sets = [["forecast"], ["forecast", "acc_id"], ["forecast", "region"],
            ["forecast", "region", "acc_id"]]
    return rows.groupingSets([[F.col(c) for c in s] for s in sets], "forecast", "region", "acc_id").agg(
        *error_aggregates(actual, "predicted", rounded=rounded)
    )


def metrics_long(scores: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, value) rows of an error table."""
    names = [c for c in scores.columns if c not in keys]
    doubles = scores.select(*keys, *[F.col(c).cast("double").alias(c) for c in names])
    return doubles.unpivot(keys, names, "metric", "value")


def _once(keys: tuple[str, ...]) -> Column:
    said = F.concat_ws(" ", F.lit("several predictions for one key:"), *[F.col(k).cast("string") for k in keys])
    return F.when(F.col("_rows") == 1, F.lit(True)).otherwise(F.raise_error(said).cast("boolean"))


def ensemble_mean(
    forecasts: list[DataFrame], keys: tuple[str, ...] = ("region", "acc_id", "year"),
    prediction: str = "prediction",
) -> DataFrame:
    """Mean of several models' predictions, matched by key.

    A key that a model predicts twice raises: it would be multiplied, not averaged.
    """
    named = [
        f.groupBy(*keys)
        .agg(F.count("*").alias("_rows"), F.first(prediction).alias(f"_p{i}"))
        .where(_once(keys))
        .drop("_rows")
        for i, f in enumerate(forecasts)
    ]
    joined = reduce(lambda a, b: a.join(b, list(keys)), named)
    total = reduce(lambda a, b: a + b, [F.col(f"_p{i}") for i in range(len(named))])
    return joined.select(*keys, (total / len(named)).alias(prediction))

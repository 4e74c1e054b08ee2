"""Descriptive tables over the panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slackline.fixed_values import SEED
from slackline.functions.numbers import exact_sum, scalar
from slackline.functions.quantiles import exact_quantiles, named, quantiles_of, summaries
from slackline.session import stored

# Copies of one row are written out in blocks of this many.
COPY_BLOCK = 65536


def sum_by(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Sums per key, independent of row order."""
    return df.groupBy(*keys).agg(*[exact_sum(c).alias(c) for c in columns])


def pct_difference(df: DataFrame, name: str = "pct_diff") -> DataFrame:
    """(budget - realized) / realized in percent, NULL for a zero divisor."""
    share = F.try_divide(F.col("budget") - F.col("realized"), F.col("realized"))
    return df.withColumn(name, share * 100)


def clip_quantiles(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Rows within the two quantiles, edges included; NULL rows drop."""
    edges = (
        exact_quantiles(df, {column: F.col(column)}, [low, high]).select("quantiles").scalar()
    )
    return df.where(F.col(column).between(F.get(edges, F.lit(0)), F.get(edges, F.lit(1))))


def mean_by_year_and_region(df: DataFrame, column: str) -> DataFrame:
    """Mean per year and per region and year in one pass; region is NULL for the former."""
    year, region = F.col("year"), F.col("region")
    return df.groupingSets([[year], [region, year]], region, year).agg(
        F.count(column).alias("n"), F.avg(column).alias("mean")
    )


def describe_series(df: DataFrame, series: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """count, mean, std, min, quartiles and max per named expression, nulls left out.

    With ``by`` per group of these columns, null being a group of its own. Two scans: moments and
    sketches, then the rows around the quartiles.
    """
    probabilities = [0.25, 0.5, 0.75]
    table = stored(summaries(df, series, probabilities, by))
    found = quantiles_of(df, series, probabilities, table.where("n > 0"), by)
    quartiles = found.select(
        "key", *[F.get("quantiles", F.lit(i)).alias(q) for i, q in enumerate(["q25", "q50", "q75"])]
    )
    return named(table.withColumnRenamed("n", "count").join(quartiles, "key", "left"), by).select(
        *by, "series", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def describe(df: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    return describe_series(df, {c: F.col(c) for c in columns}, by)


def top_k(df: DataFrame, column: str, k: int, keys: list[str]) -> DataFrame:
    """The k largest rows, NULL last; ``keys`` settle ties."""
    return df.orderBy(F.col(column).desc_nulls_last(), *keys).limit(k)


def head(df: DataFrame, k: int, keys: list[str]) -> DataFrame:
    return df.orderBy(*keys).limit(k)


def tail(df: DataFrame, k: int, keys: list[str]) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() for c in keys]).limit(k)


def seeded_sample(df: DataFrame, keys: list[str], n: int, seed: int = SEED) -> DataFrame:
    """n rows in the order of a hash of their keys: random, and the same every time."""
    ticket = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(ticket, *keys).limit(n)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share per value, most frequent first, NULL left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = scalar(counts, F.sum("n"))
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), column)


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def duplicates(df: DataFrame, expand: bool = False) -> DataFrame:
    """Rows that repeat an earlier row, as one line with ``copies`` per distinct row.

    Equal rows are counted map-side, so a row that fills a third of the table is one line.
    ``expand`` writes every copy out, in blocks that are spread over the cluster.
    """
    columns = df.columns
    counted = (
        df.groupBy(*columns)
        .agg((F.count("*") - 1).alias("copies"))
        .where(F.col("copies") > 0)
    )
    if not expand:
        return counted
    last = F.floor((F.col("copies") - 1) / COPY_BLOCK)
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    size = F.least(F.lit(COPY_BLOCK), F.col("copies") - F.col("_block") * COPY_BLOCK)
    spread = blocks.withColumn("_size", size.cast("int")).repartition(*columns, "_block")
    return spread.select(*columns, F.explode(F.array_repeat(F.lit(1), F.col("_size"))).alias("_one")).drop("_one")


def histogram(df: DataFrame, column: str, bins: int, density: bool = False) -> DataFrame:
    """(bin, low, high, n) of equal-width bins between min and max; the last bin is closed.

    ``df`` is read twice, for the bounds and for the counts.
    """
    value = F.col(column).cast("double")
    bounds = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    flat = bounds["lo"] == bounds["hi"]
    low = F.when(flat, bounds["lo"] - 0.5).otherwise(bounds["lo"])
    high = F.when(flat, bounds["hi"] + 0.5).otherwise(bounds["hi"])
    spot = F.floor(F.lit(bins) * (value - low) / (high - low))
    counts = (
        df.where(value.isNotNull())
        .groupBy(F.least(spot, F.lit(bins - 1)).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    width = (high - low) / bins
    edges = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    table = edges.join(counts, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    if not density:
        return table
    total = scalar(counts, F.sum("n"))
    return table.withColumn("density", F.try_divide(F.col("n"), total * width))


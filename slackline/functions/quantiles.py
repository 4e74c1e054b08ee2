"""Exact quantiles, also per group, without collecting a column into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slackline.functions.joins import lookup_join
from slackline.session import stored

# The sketch places a quantile within 1 / ACCURACY of its rank. Every task sends one sketch per
# group, so it is kept small.
ACCURACY = 1000
# Different values that one task sorts for a rank; a larger range is cut into PARTS of equal depth.
MOST_CELLS = 100_000
PARTS = 64


def summaries(
    df: DataFrame,
    series: dict[str, Column],
    probabilities: list[float],
    by: tuple[str, ...] = (),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """(key, n, mean, std, min, max, edges) per group and named expression, from one aggregate.

    ``key`` is a struct of the group's columns and the name of the series, so that null groups
    compare equal. ``edges`` has a lower and an upper value around every wanted quantile, two
    error bounds of the sketch away; of few rows, all lie within.
    """
    if probabilities != sorted(probabilities):
        raise ValueError("probabilities must ascend")
    step = 2.0 / accuracy
    cuts = [p + side for p in probabilities for side in (-step, step)]
    inside = [min(max(c, 0.0), 1.0) for c in cuts]

    def one(name: str) -> Column:
        value = series[name].cast("double")
        return F.struct(
            _key(by, name).alias("key"),
            F.count(value).alias("n"),
            F.avg(series[name]).alias("mean"),
            F.stddev_samp(series[name]).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.percentile_approx(value, inside, accuracy).alias("sketch"),
        )

    table = df.groupBy(*by).agg(F.array(*[one(name) for name in series]).alias("s")).select(F.inline("s"))
    few = F.col("n") * step < 2
    edges = F.array(
        *[
            F.when(few | F.lit(c <= 0 or c >= 1), F.col("min") if j % 2 == 0 else F.col("max")).otherwise(F.get("sketch", F.lit(j)))
            for j, c in enumerate(cuts)
        ]
    )
    return table.withColumn("edges", edges).drop("sketch")


def _key(by: tuple[str, ...], name: str) -> Column:
    return F.struct(*[F.col(c).alias(f"by{i}") for i, c in enumerate(by)], F.lit(name).alias("series"))


def named(table: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``table`` with the parts of ``key`` as columns."""
    return table.select(
        *[F.col(f"key.by{i}").alias(c) for i, c in enumerate(by)], F.col("key.series").alias("series"),
        *[c for c in table.columns if c != "key"],
    )


def exact_quantiles(
    df: DataFrame,
    series: dict[str, Column],
    probabilities: list[float],
    accuracy: int = ACCURACY,
    by: tuple[str, ...] = (),
    most: int = MOST_CELLS,
) -> DataFrame:
    """One row ``(by..., series, n, quantiles)`` per group and named expression, nulls left out."""
    table = stored(summaries(df, series, probabilities, by, accuracy).where("n > 0"))
    return named(quantiles_of(df, series, probabilities, table, by, most), by)


def quantiles_of(
    df: DataFrame,
    series: dict[str, Column],
    probabilities: list[float],
    table: DataFrame,
    by: tuple[str, ...] = (),
    most: int = MOST_CELLS,
) -> DataFrame:
    """(key, n, quantiles), interpolated linearly between the two neighbouring rows.

    ``df`` is read a second time: rows between a pair of edges of ``table`` are counted per
    value, all others only per gap, both map-side, so a third of all rows in one value is one
    counted cell. Running counts tell which range holds a rank. A range of more than ``most``
    different values is cut into parts of equal depth, by a sketch of what is in it, until the
    part that holds the rank is small enough for one task; nothing but counts of the other parts
    is kept. Should a rank lie beyond its edges, that gap is read once more.
    """
    long = F.inline(F.array(*[F.struct(_key(by, name).alias("key"), x.cast("double").alias("value")) for name, x in series.items()]))
    rows = lookup_join(df.select(long).where("value IS NOT NULL"), table.select("key", "edges"), ["key"])
    value, edges = F.col("value"), F.col("edges")
    place = F
    for j in range(0, 2 * len(probabilities), 2):
        # Even places are gaps, odd ones lie between the two edges of a quantile.
        place = place.when(value < edges[j], j).when(value <= edges[j + 1], j + 1)
    placed = rows.select("key", place.otherwise(2 * len(probabilities)).cast("long").alias("place"), "value")
    near = F.when(F.col("place") % 2 == 1, value)
    cells = placed.groupBy("key", "place", near.alias("value")).agg(F.count("*").alias("rows"))
    cells = stored(cells)
    wanted = F.array(
        *[
            F.struct(F.lit(2 * i + side).alias("slot"), rounding(F.lit(p) * (F.col("n") - 1)).cast("long").alias("rank"))
            for i, p in enumerate(probabilities)
            for side, rounding in enumerate((F.floor, F.ceil))
        ]
    )
    whole = table.select("key", F.lit(0).cast("long").alias("first"), wanted.alias("wanted"))
    spots = stored(_holding(cells, whole, ["key"]))
    if not spots.where("place % 2 = 0").isEmpty():
        missed = lookup_join(placed, spots.where("place % 2 = 0").select("key", "place"), ["key", "place"], "left_semi")
        cells = cells.where("value IS NOT NULL").union(missed.groupBy("key", "place", "value").agg(F.count("*").alias("rows")))
    cells = stored(lookup_join(cells, spots.select("key", "place"), ["key", "place"], "left_semi"))
    while True:
        sizes = cells.groupBy("key", "place").agg(F.count("*").alias("cells"))
        large = stored(sizes.where(F.col("cells") > most).select("key", "place"))
        if large.isEmpty():
            break
        cells, spots = _narrowed(cells, spots, large)
    upto = Window.partitionBy("key", "place").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    picked = (
        lookup_join(cells, spots, ["key", "place"])
        .withColumn("start", F.col("first") + F.coalesce(F.sum("rows").over(upto), F.lit(0)))
        .withColumn("hits", _ranks_in(F.col("wanted"), "start", "rows"))
        .where(F.size("hits") > 0)
        .select("key", "value", F.explode("hits.slot").alias("slot"))
    )
    slots = [F.max(F.when(F.col("slot") == i, F.col("value"))).alias(f"slot{i}") for i in range(2 * len(probabilities))]
    both = table.select("key", "n").join(picked.groupBy("key").agg(*slots), "key")
    quantiles = []
    for i, p in enumerate(probabilities):
        position = F.lit(p) * (F.col("n") - 1)
        low, high = F.col(f"slot{2 * i}"), F.col(f"slot{2 * i + 1}")
        quantiles.append(low + (high - low) * (position - F.floor(position)))
    return both.select("key", "n", F.array(*quantiles).alias("quantiles"))


def _holding(cells: DataFrame, above: DataFrame, on: list[str]) -> DataFrame:
    """(key, place, first, wanted): the places that hold a wanted rank.

    ``above`` has what the places of a common ``on`` share: the rank of their first row and the
    ranks wanted of them.
    """
    before = Window.partitionBy(*on).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    counts = cells.groupBy(*dict.fromkeys(["key", "place", *on])).agg(F.sum("rows").alias("inside"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("inside").over(before), F.lit(0)))
    starts = lookup_join(counts, above, on).withColumn("first", F.col("first") + F.col("_before"))
    held = starts.withColumn("wanted", _ranks_in(F.col("wanted"), "first", "inside"))
    return held.where(F.size("wanted") > 0).select("key", "place", "first", "wanted")


def _narrowed(cells: DataFrame, spots: DataFrame, large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``cells`` and ``spots`` with every ``large`` place replaced by its parts that hold a rank."""
    at = ["key", "place"]
    inner = lookup_join(cells, large, at, "left_semi")
    steps = [i / PARTS for i in range(1, PARTS)]
    cuts = inner.groupBy(*at).agg(F.percentile_approx("value", steps, ACCURACY).alias("cuts"))
    parts = lookup_join(inner, stored(cuts), at)
    # The number of cuts below the value, by halving.
    halves = F.array(*[F.lit(1 << b) for b in reversed(range(PARTS.bit_length()))])
    below = F.aggregate(
        halves, F.lit(0), lambda at, half: F.when(F.get("cuts", at + half - 1) < F.col("value"), at + half).otherwise(at)
    )
    part = (F.col("place") * (PARTS + 1) + below + PARTS).cast("long")
    parts = stored(parts.select("key", F.col("place").alias("whole"), part.alias("place"), "value", "rows"))
    above = spots.select("key", F.col("place").alias("whole"), "first", "wanted")
    found = _holding(parts, above, ["key", "whole"])
    spots = stored(spots.join(large, at, "left_anti").unionByName(found))
    rest = cells.join(large, at, "left_anti").unionByName(parts.drop("whole"))
    return stored(lookup_join(rest, spots.select(*at), at, "left_semi")), spots


def _ranks_in(ranks: Column, first: str, length: str) -> Column:
    """The ranks that fall into ``length`` rows starting at rank ``first``."""
    start = F.col(first)
    return F.filter(
        ranks, lambda w: (w["rank"] >= start) & (w["rank"] < start + F.col(length))
    )

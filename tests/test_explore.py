import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from slackline.functions import quantiles
from slackline.functions.quantiles import exact_quantiles
from slackline.operators import explore
from tests.conftest import values

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def check(df, column, numbers, accuracy=quantiles.ACCURACY):
    row = exact_quantiles(df, {"x": F.col(column)}, PROBABILITIES, accuracy).first()
    assert row["n"] == len(numbers)
    assert row["quantiles"] == pytest.approx(np.quantile(numbers, PROBABILITIES), rel=1e-12, abs=1e-12)


def test_small_path(spark):
    numbers = [3.0, 1.0, 2.0, 10.0]
    check(spark.createDataFrame([(v,) for v in [*numbers, None]], "x double").coalesce(1), "x", numbers)


def test_two_passes_on_even_and_hot_values(spark, monkeypatch):
    generator = np.random.default_rng(1)
    spread = generator.normal(0, 1000, 20000)
    hot = np.where(np.arange(20000) % 3 == 0, 7.5, np.round(generator.exponential(50, 20000), 2))
    whole = generator.integers(0, 4, 20000).astype(float)
    for numbers in (spread, hot, whole, np.full(50, 3.0), np.array([5.0])):
        df = spark.createDataFrame([(float(v),) for v in numbers], "x double").repartition(4)
        check(df, "x", numbers, accuracy=50)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50).map(lambda i: i / 4), min_size=1, max_size=60))
def test_two_passes_any_list(spark, monkeypatch, numbers):
    check(spark.createDataFrame([(v,) for v in numbers], "x double"), "x", numbers, accuracy=10)


def by_group(rows, probabilities):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    return {g: list(np.quantile(v, probabilities)) for g, v in groups.items()}


def test_quantiles_per_group_with_a_hot_and_a_null_group(spark):
    generator = np.random.default_rng(4)
    hot = [("hot", float(v)) for v in np.exp(generator.normal(0, 3, 9000))]
    few = [(f"g{i % 40}", float(i)) for i in range(300)] + [(None, float(i % 7)) for i in range(500)] + [("none", None)]
    df = spark.createDataFrame(hot + few, "g string, x double").repartition(4)
    out = exact_quantiles(df, {"x": F.col("x")}, PROBABILITIES, accuracy=50, by=("g",), most=50).collect()
    want = by_group(hot + few, PROBABILITIES)
    assert {r["g"] for r in out} == set(want)
    for r in out:
        assert r["quantiles"] == pytest.approx(want[r["g"]], rel=1e-12)


def test_heavy_tail_is_cut_into_parts_of_equal_depth(spark, monkeypatch):
    """Nearly all values lie within a billionth of the range; no part has twice its share."""
    generator = np.random.default_rng(5)
    numbers = np.exp(generator.normal(0, 8, 20000))
    df = spark.createDataFrame([(float(v),) for v in numbers], "x double").repartition(4)
    parts, narrowed = [], quantiles._narrowed

    def watched(cells, spots, large):
        large_cells = cells.join(large, ["key", "place"], "left_semi")
        sizes = large_cells.groupBy("key", "place").count().collect()
        before = {r["place"]: r["count"] for r in sizes}
        cells, spots = narrowed(cells, spots, large)
        for r in cells.groupBy("place").count().collect():
            whole = (r["place"] - quantiles.PARTS) // (quantiles.PARTS + 1)
            if whole in before:
                parts.append(r["count"] / (before[whole] / quantiles.PARTS))
        return cells, spots

    monkeypatch.setattr(quantiles, "_narrowed", watched)
    row = exact_quantiles(df, {"x": F.col("x")}, PROBABILITIES, accuracy=20, most=40).first()
    assert row["quantiles"] == pytest.approx(np.quantile(numbers, PROBABILITIES), rel=1e-12)
    assert parts and max(parts) < 2


def test_ranks_beyond_their_edges_are_read_again(spark, monkeypatch):
    numbers = [float(v) ** 3 for v in range(5000)]
    df = spark.createDataFrame([(v,) for v in numbers], "x double").repartition(3)
    series, probabilities = {"x": F.col("x")}, [0.25, 0.5, 0.9]
    table = quantiles.summaries(df, series, probabilities)
    wrong = table.withColumn("edges", F.array(*[F.lit(float(e)) for e in (-2, -1, 8e9, 9e9, 1e12, 2e12)]))
    row = quantiles.quantiles_of(df, series, probabilities, wrong, most=100).first()
    assert row["quantiles"] == pytest.approx(np.quantile(numbers, probabilities), rel=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, "a")], "x double, g string")
    assert exact_quantiles(df, {"x": F.col("x")}, [0.5]).collect() == []
    assert exact_quantiles(df.limit(0), {"x": F.col("x")}, [0.5], by=("g",)).collect() == []


def test_probabilities_must_ascend(spark):
    with pytest.raises(ValueError, match="ascend"):
        exact_quantiles(spark.range(3), {"x": F.col("id")}, [0.5, 0.25])


def test_several_series_share_the_passes(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    series = {str(g): F.when(F.col("g") == g, F.col("v")) for g in (0, 1, 2)}
    out = {r["series"]: r["quantiles"] for r in exact_quantiles(df, series, [0.5]).collect()}
    assert out == {"0": [499.0], "1": [500.0]}


def test_describe(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 4.0, None]], "x double")
    r = explore.describe(df, ["x"]).first()
    assert (r["count"], r["mean"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]) == (
        4, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0,
    )
    assert r["std"] == pytest.approx(np.std([1, 2, 3, 4], ddof=1))


def test_describe_by_group(spark):
    rows = [("a", 1, 4.0), ("a", 1, 6.0), ("a", 2, 1.0), (None, 1, 3.0), (None, 1, 5.0), ("b", 1, None)]
    df = spark.createDataFrame(rows, "g string, y int, x double")
    out = explore.describe(df, ["x"], by=("g", "y"))
    assert out.columns[:4] == ["g", "y", "series", "count"]
    assert values(out, "g", "y", "count", "mean", "min", "q25", "q50", "q75", "max") == [
        (None, 1, 2, 4.0, 3.0, 3.5, 4.0, 4.5, 5.0),
        ("a", 1, 2, 5.0, 4.0, 4.5, 5.0, 5.5, 6.0),
        ("a", 2, 1, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        ("b", 1, 0, None, None, None, None, None, None),
    ]


def test_describe_scans_twice(spark, tmp_path):
    path = str(tmp_path / "scanned_source")
    spark.range(5000).selectExpr("id % 3 AS g", "id * id AS x").write.parquet(path)
    scans = []
    original = explore.stored

    def counted(df):
        scans.append(any("scanned_source" in f for f in df.inputFiles()))
        return original(df)

    explore.stored, quantiles.stored = counted, counted
    try:
        assert explore.describe(spark.read.parquet(path), ["x"], by=("g",)).count() == 3
    finally:
        explore.stored, quantiles.stored = original, original
    assert sum(scans) == 2


def test_clip_keeps_the_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)] + [(None,)], "x double")
    kept = explore.clip_quantiles(df, "x")
    assert values(kept)[0] == (1.0,) and values(kept)[-1] == (99.0,) and kept.count() == 99


def test_pct_difference_of_zero_is_unknown(spark):
    df = spark.createDataFrame([(3.0, 2.0), (1.0, 0.0), (0.0, 0.0)], "budget double, realized double")
    assert values(explore.pct_difference(df), "pct_diff") == [(None,), (None,), (50.0,)]


def test_histogram_edges_and_empty_bins(spark):
    numbers = [0.0, 1.0, 1.0, 10.0]
    df = spark.createDataFrame([(v,) for v in [*numbers, None]], "x double")
    counts, edges = np.histogram(numbers, bins=5)
    out = sorted(explore.histogram(df, "x", 5, density=True).collect())
    assert [r["n"] for r in out] == list(counts)
    assert [r["low"] for r in out] == pytest.approx(edges[:-1])
    assert sum(r["density"] * (r["high"] - r["low"]) for r in out) == pytest.approx(1.0)


def test_histogram_of_one_value(spark):
    out = sorted(explore.histogram(spark.createDataFrame([(2.0,)], "x double"), "x", 4).collect())
    assert [r["n"] for r in out] == list(np.histogram([2.0], bins=4)[0])
    assert (out[0]["low"], out[-1]["high"]) == (1.5, 2.5)


def test_duplicates_compact_and_expanded(spark, monkeypatch):
    monkeypatch.setattr(explore, "COPY_BLOCK", 4)
    df = spark.createDataFrame([("a", 1)] * 10 + [("b", 1)] * 2 + [("c", None)] * 2 + [("d", 1)], "k string, v int")
    assert values(explore.duplicates(df)) == [("a", 1, 9), ("b", 1, 1), ("c", None, 1)]
    assert values(explore.duplicates(df, expand=True)) == [("a", 1)] * 9 + [("b", 1), ("c", None)]


def test_value_shares(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert [tuple(r) for r in explore.value_shares(df, "k").collect()] == [("a", 2, 2 / 3), ("b", 1, 1 / 3)]


def test_sample_is_repeatable_and_seeded(spark):
    df = spark.range(1000)
    one = values(explore.seeded_sample(df, ["id"], 10, seed=1))
    assert one == values(explore.seeded_sample(df.repartition(7), ["id"], 10, seed=1))
    assert one != values(explore.seeded_sample(df, ["id"], 10, seed=2))
    assert len(one) == 10


def test_top_k_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 5.0), (4, None)], "k int, x double")
    assert [r["k"] for r in explore.top_k(df, "x", 3, ["k"]).collect()] == [2, 1, 3]
    assert [r["k"] for r in explore.head(df, 2, ["k"]).collect()] == [1, 2]
    assert [r["k"] for r in explore.tail(df, 2, ["k"]).collect()] == [4, 3]


def test_sums_do_not_depend_on_row_order(spark):
    rows = [("a", 0.1)] * 10 + [("a", 1e9), ("a", -1e9)]
    one = explore.sum_by(spark.createDataFrame(rows, "k string, x double"), ["k"], ["x"])
    other = explore.sum_by(spark.createDataFrame(rows[::-1], "k string, x double"), ["k"], ["x"])
    assert values(one) == values(other) == [("a", 1.0)]


def test_means_at_both_levels(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 3.0)], "year int, region string, x double")
    out = explore.mean_by_year_and_region(df, "x")
    assert values(out, "region", "year", "n", "mean") == [(None, 1, 2, 2.0), ("a", 1, 1, 1.0), ("b", 1, 1, 3.0)]

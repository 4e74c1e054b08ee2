import pytest
from pyspark.sql import functions as F

from slackline.operators import features
from tests.conftest import values

PANEL = "region string, acc_id int, year int, realized double, budget double"


@pytest.fixture
def series(spark):
    return spark.createDataFrame(
        [
            ("AG", 30, 2011, 1.0, 9.0),
            ("AG", 30, 2012, 2.0, 9.0),
            ("AG", 30, 2015, None, 9.0),  # a gap before, and an unknown amount
            ("AG", 30, 2016, 5.0, 9.0),
            ("BE", 31, 2012, 7.0, 9.0),  # one row only
        ],
        PANEL,
    )


def test_lag_is_by_row_within_a_series(series):
    out = features.add_lags(series)
    assert values(out.where("region = 'AG'"), "year", "realized_lag1", "realized_lag2") == [
        (2011, None, None),
        (2012, 1.0, None),
        (2015, 2.0, 1.0),
        (2016, None, 2.0),
    ]
    assert values(out.where("region = 'BE'"), "realized_lag1") == [(None,)]


def test_lag_by_year_leaves_gaps_unknown(series):
    out = features.add_lags(series, by="year").where("region = 'AG'")
    assert values(out, "year", "realized_lag1", "realized_lag2") == [
        (2011, None, None),
        (2012, 1.0, None),
        (2015, None, None),
        (2016, None, None),
    ]


def test_duplicate_years_follow_the_tie_break(spark):
    rows = spark.createDataFrame(
        [("AG", 30, 2011, 1.0, "HRM2"), ("AG", 30, 2011, 2.0, "HRM1"), ("AG", 30, 2012, 3.0, "HRM2")],
        "region string, acc_id int, year int, realized double, standard string",
    )
    out = features.add_lags(rows, tie_break=("standard",))
    assert values(out, "year", "standard", "realized_lag1") == [
        (2011, "HRM1", None),
        (2011, "HRM2", 2.0),
        (2012, "HRM2", 1.0),
    ]


def test_lag_needs_year_and_amount(series):
    with pytest.raises(ValueError, match="realized"):
        features.add_lags(series.drop("realized"))
    with pytest.raises(ValueError, match="unknown lag mode"):
        features.add_lags(series, by="month")


def test_rebase_counts_from_the_oldest_year(series):
    years = {r["year"] for r in features.rebase_year(series).collect()}
    assert years == {0, 1, 4, 5}


def test_zero_rows_null_is_not_zero(spark):
    pairs = [(0.0, 0.0), (0.0, 5.0), (5.0, 0.0), (None, 0.0), (0.0, None), (None, None)]
    rows = spark.createDataFrame(
        [(r, b, acc) for acc in (10, 30) for r, b in pairs],
        "realized double, budget double, acc_id int",
    )
    kept = features.drop_zero_rows(rows)
    assert values(kept.where("acc_id = 30"), "realized", "budget") == [
        (None, None), (None, 0.0), (0.0, None), (0.0, 5.0), (5.0, 0.0),
    ]
    assert values(kept.where("acc_id = 10"), "realized", "budget") == [
        (None, None), (0.0, None), (0.0, 5.0),
    ]


def test_categories(series):
    assert features.choose_accounts(series, None).count() == 5
    assert features.choose_accounts(series, "Personalaufwand").count() == 4
    assert features.choose_accounts(series, "Ertrag").count() == 0
    with pytest.raises(ValueError, match="unknown category"):
        features.choose_accounts(series, "Nichts")


def test_lags_come_before_the_row_filters(spark):
    rows = spark.createDataFrame(
        [("AG", 30, 2011, 0.0, 0.0), ("AG", 30, 2012, 3.0, 1.0)], PANEL
    )
    out = features.engineer(rows, "Alle")
    assert values(out, "year", "realized", "realized_lag1") == [(1, 3.0, 0.0)]


def test_holdout_parts_are_disjoint_and_complete(series):
    train, test = features.holdout(series)
    assert train.count() + test.count() == series.count()
    assert values(test, "region", "year") == [("AG", 2016)]
    assert train.agg(F.max("year")).first()[0] == 2015


def test_cutoff_of_a_slice_without_the_newest_year(series):
    _, by_all = features.holdout(series, region="BE")
    _, by_slice = features.holdout(series, region="BE", cutoff="slice")
    assert by_all.count() == 0
    assert values(by_slice, "year") == [(2012,)]


def test_single_year_frame_is_all_test(series):
    train, test = features.holdout(series.where("year = 2012"))
    assert (train.count(), test.count()) == (0, 2)


def test_features_hold_no_leaks(series):
    left = features.feature_columns(series.withColumns({"slack": F.lit(1), "budget_next": F.lit(1)}))
    assert left.columns == ["region", "acc_id", "year"]


@pytest.mark.parametrize("chunks", [1, 7, 40])
def test_chunked_lags_equal_plain_lags(spark, chunks):
    # One series holds a third of all rows; others are shorter than the lag reach.
    hot = F.col("id") % 3 == 0
    rows = spark.range(600).select(
        F.when(hot, "AG").otherwise(F.concat(F.lit("R"), (F.col("id") % 120).cast("string"))).alias("region"),
        F.lit(30).alias("acc_id"),
        (2000 + F.col("id") % 11).cast("int").alias("year"),
        F.when(F.col("id") % 13 > 0, F.col("id").cast("double")).alias("realized"),
        F.col("id").alias("entry"),
    )
    plain = features.add_lags(rows, tie_break=("entry",))
    chunked = features.add_lags_in_chunks(rows, tie_break=("entry",), chunks=chunks)
    assert chunked.columns == plain.columns
    assert values(chunked) == values(plain)


def test_chunks_split_a_series_of_equal_rows(spark):
    rows = spark.range(200).select(
        F.lit("AG").alias("region"), F.lit(30).alias("acc_id"), F.lit(2011).alias("year"),
        F.lit(1.0).alias("realized"),
    )
    out = features.add_lags_in_chunks(rows, ks=(1,), chunks=8)
    assert values(out, "realized_lag1") == [(None,)] + [(1.0,)] * 199


def test_equal_years_have_one_order(spark):
    rows = [("A", 1, 2010, float(i), f"s{i}") for i in range(6)] + [("A", 1, 2011, 9.0, "s9")]
    columns = "region string, acc_id int, year int, realized double, standard string"
    seen = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, columns).repartition(parts)
        by_row = features.add_lags(df).collect()
        by_year = features.add_lags(df, by="year").collect()
        seen.add(tuple(sorted((r["standard"], r["realized_lag1"]) for r in by_row if r["realized_lag1"] is not None)))
        assert {r["realized_lag1"] for r in by_year if r["year"] == 2011} == {0.0}
    assert len(seen) == 1

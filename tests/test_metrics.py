import math

import pytest

from slackline.operators import metrics
from tests.conftest import values


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [
            ("AG", 30, 10.0, 12.0, 9.0),
            ("AG", 31, -4.0, -2.0, -4.0),
            ("BE", 30, 0.0, 1.0, 0.0),
        ],
        "region string, acc_id int, realized double, model double, budget double",
    )


def test_errors(rows):
    r = metrics.evaluate(rows, "realized", "model").first()
    assert r["n"] == 3
    assert r["mae"] == pytest.approx(5 / 3)
    assert r["mse"] == pytest.approx(3.0)
    assert r["rmse"] == pytest.approx(math.sqrt(3))
    assert r["mape"] == pytest.approx((0.2 + 0.5 + 1 / 2.220446049250313e-16) / 3)
    assert r["mape_nonzero"] == pytest.approx(0.35)


def test_rounded_root_is_taken_of_the_rounded_square(spark):
    rows = spark.createDataFrame([(0.0, 0.07)], "realized double, model double")
    r = metrics.evaluate(rows, "realized", "model", rounded=True).first()
    assert (r["mse"], r["rmse"]) == (0.0, 0.0)
    assert metrics.evaluate(rows, "realized", "model").first()["rmse"] == pytest.approx(0.07)


def test_half_way_rounds_to_even(spark):
    rows = spark.createDataFrame([(0.0, 0.125)], "realized double, model double")
    assert metrics.evaluate(rows, "realized", "model", rounded=True).first()["mae"] == 0.12


def test_single_zero_row(spark):
    rows = spark.createDataFrame([(0.0, 0.0)], "realized double, model double")
    r = metrics.evaluate(rows, "realized", "model").first()
    assert (r["n"], r["mae"], r["mape"], r["mape_nonzero"]) == (1, 0.0, 0.0, None)


def test_missing_forecasts_do_not_count(spark):
    rows = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "realized double, model double")
    r = metrics.evaluate(rows, "realized", "model").first()
    assert (r["n"], r["mae"]) == (1, 1.0)


def test_slices_equal_separate_runs(rows):
    table = metrics.compare_slices(rows, "realized", ["model", "budget"])
    got = {(r["forecast"], r["region"], r["acc_id"]): r["mae"] for r in table.collect()}
    assert len(got) == 2 * (1 + 2 + 2 + 3)
    one = metrics.evaluate(rows.where("region = 'AG'"), "realized", "model").first()["mae"]
    assert got[("model", "AG", None)] == one
    assert got[("budget", None, 30)] == 0.5
    assert got[("model", None, None)] == pytest.approx(5 / 3)


def test_metric_rows(rows):
    table = metrics.metrics_long(metrics.compare(rows, "realized", ["model"]), ["forecast"])
    assert values(table.where("metric = 'n'")) == [("model", "n", 3.0)]
    assert table.count() == 6


def test_ensemble_matches_by_key(spark):
    one = spark.createDataFrame([("AG", 30, 5, 1.0), ("BE", 30, 5, 3.0)],
                                "region string, acc_id int, year int, prediction double")
    two = spark.createDataFrame([("BE", 30, 5, 5.0), ("AG", 30, 5, 2.0)], one.schema)
    out = metrics.ensemble_mean([one, two])
    assert values(out, "region", "prediction") == [("AG", 1.5), ("BE", 4.0)]

import pytest
from pyspark.sql import functions as F

from slackline.fixed_values import CROSSWALK
from slackline.operators import ledger
from tests.conftest import values

TEXT = "acc_id string, budget string, realized string, budget_next string"


def test_crosswalk_covers_every_key_and_conserves_amounts(spark):
    old = [*CROSSWALK, "77"]
    rows = spark.createDataFrame(
        [(a, 12.0, 24.0, 36.0) for a in old],
        "acc_id string, budget double, realized double, budget_next double",
    )
    out = ledger.apply_crosswalk(rows)
    assert out.count() == sum(len(v) for v in CROSSWALK.values()) + 1
    for c, each in (("budget", 12.0), ("realized", 24.0), ("budget_next", 36.0)):
        assert out.agg(F.sum(c)).first()[0] == pytest.approx(each * len(old))
    assert values(out.where("acc_id = '77'"), "budget") == [(12.0,)]
    assert values(out.where("acc_id = '41'"), "budget") == [(6.0,)]


def test_crosswalk_collision_is_summed_on_request(spark):
    rows = spark.createDataFrame(
        [("AG", "32", 8.0, 1.0), ("AG", "34 - 37", 8.0, 4.0)],
        "region string, acc_id string, budget double, realized double",
    )
    side = ledger.apply_crosswalk(rows).where("acc_id = '34'")
    assert values(side, "budget") == [(2.0,), (8.0,)]
    summed = ledger.apply_crosswalk(rows, aggregate=True).where("acc_id = '34'")
    assert values(summed, "budget", "realized") == [(10.0, 2.0)]


def test_only_plain_numbers_count(spark):
    cells = ["1d", " 12 ", "", None, "n/a", "-3.5", "1e3", ".5", "0x1", "5."]
    rows = spark.createDataFrame([(c,) for c in cells], "budget string")
    out = [r[0] for r in ledger.numbers_or_null(rows, ["budget"]).collect()]
    assert out == [None, 12.0, None, None, None, -3.5, 1000.0, 0.5, None, 5.0]


def test_slack_and_missing_amounts(spark):
    rows = spark.createDataFrame(
        [("1", "10", "4", "0"), ("2", "0", "4", None), ("3", None, "4", ""), ("4", "10", "x", "1d")], TEXT
    )
    out = ledger.zeros_for_null(ledger.with_slack(ledger.numbers_or_null(rows)))
    assert values(out, "acc_id", "budget", "realized", "slack") == [
        ("1", 10.0, 4.0, 6.0),
        ("2", 0.0, 4.0, 0.0),
        ("3", 0.0, 4.0, 0.0),
        ("4", 10.0, 0.0, 0.0),
    ]


def test_numeric_accounts_and_levels(spark):
    rows = spark.createDataFrame([(a,) for a in ["3", "30", "0", "A3", "3.0", "", None]], "acc_id string")
    assert values(ledger.keep_numeric_accounts(rows)) == [("0",), ("3",), ("30",)]
    kept = ledger.with_level(ledger.keep_numeric_accounts(rows, drop_zero=True))
    assert values(kept, "acc_id", "level") == [("3", 1), ("30", 2)]


def test_reference_filter(spark):
    rows = spark.createDataFrame([("HRM2_ER1",), ("x",), (None,), ("",)], "ref_id string")
    assert values(ledger.keep_referenced(rows)) == [("HRM2_ER1",)]


def standards(spark):
    both = [("AA", "HRM1", 5.0)]
    only_new = [("BB", "HRM2", 0.0)]
    full = [("CC", "HRM1", 5.0), ("CC", "HRM2", 6.0)]
    hollow = [("DD", "HRM1", 5.0), ("DD", "HRM2", 0.0)]
    rows = [(2015, r, s, "30", v, 0.0) for r, s, v in both + only_new + full + hollow]
    return spark.createDataFrame(
        rows,
        "year int, region string, standard string, acc_id string, realized double, budget double",
    )


def test_new_standard_preferred_unless_hollow(spark):
    out = ledger.prefer_standard(standards(spark))
    assert values(out, "region", "standard") == [
        ("AA", "HRM1"), ("BB", "HRM2"), ("CC", "HRM2"), ("DD", "HRM1"),
    ]


def test_keep_all_and_unknown_mode(spark):
    assert ledger.prefer_standard(standards(spark), "keep_all").count() == 6
    with pytest.raises(ValueError, match="unknown mode"):
        ledger.prefer_standard(standards(spark), "first")


def test_preference_by_shuffle_join_is_the_same(spark, conf):
    expected = values(ledger.prefer_standard(standards(spark)))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert values(ledger.prefer_standard(standards(spark))) == expected
    conf("spark.sql.adaptive.enabled", "false")
    assert values(ledger.prefer_standard(standards(spark))) == expected


def test_populated_looks_at_one_and_two_digit_rows(spark):
    rows = spark.createDataFrame(
        [("a", "3", 5.0, 0.0), ("a", "4", -5.0, 0.0), ("b", "30", 0.0, 1.0), ("c", "301", 9.0, 9.0)],
        "k string, acc_id string, realized double, budget double",
    )
    assert values(ledger.populated(rows, ["k"])) == [("a", False), ("b", True), ("c", False)]


def test_union_by_name_and_defaults(spark):
    new = spark.createDataFrame([("R1", "n", 1)], "ref_id string, name string, x int")
    old = spark.createDataFrame([(2, None)], "x int, name string")
    out = ledger.fill_defaults(ledger.union_by_name([new, old]))
    assert values(out, "ref_id", "name", "x") == [("HRM1", "Missing Name", 2), ("R1", "n", 1)]


def test_year_is_checked(spark):
    good = spark.createDataFrame([("30", "2015")], "acc_id string, year string")
    assert ledger.typed(good).first()["year"] == 2015
    bad = spark.createDataFrame([("30", "XXXX")], "acc_id string, year string")
    with pytest.raises(Exception, match="not a year"):
        ledger.typed(bad).collect()

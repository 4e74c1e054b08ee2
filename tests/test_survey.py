import pytest
from pyspark.sql import functions as F

from slackline.fixed_values import AGE_LABELS, CONSENT, EXPERIENCE_LABELS
from slackline.operators import survey
from tests.conftest import values

ARMS = ["AI", "NonAI"]


def test_funnel_and_its_changes(spark):
    rows = spark.createDataFrame(
        [
            (CONSENT, "1", "Yes", "FL_74"),
            (CONSENT, "1", "No", "FL_74"),
            (CONSENT, "1", "No", "FL_76"),
            (CONSENT, None, None, "FL_76"),
            ("No", None, None, None),
        ],
        "Consent string, Scenario1_Answer_1 string, Manip_Check string, FL_23_DO string",
    )
    out = values(survey.funnel(rows), "step_no", "participants", "pct_change")
    assert out == [(1, 4, 0.0), (2, 3, -25.0), (3, 3, 0.0), (4, 2, pytest.approx(-100 / 3))]
    empty = values(survey.funnel(rows.where("false")), "participants", "pct_change")
    assert empty == [(0, 0.0)] * 4


def test_check_of_unknown_answers_fails(spark):
    rows = spark.createDataFrame([(None, "Yes"), ("FL_74", None), ("FL_76", "No")], "a string, c string")
    assert [r[0] for r in rows.select(survey.passed_check("a", "c")).collect()] == [False, False, True]


def test_final_answer_order(spark):
    rows = spark.createDataFrame(
        [(1.0, 2.0, 3.0), (None, 2.0, 3.0), (None, None, 3.0), (None, None, None)],
        "ai double, no double, first double",
    )
    out = [r[0] for r in rows.select(survey.final_answer(["ai", "no"], "first")).collect()]
    assert out == [1.0, 2.0, 3.0, None]


def test_age_edges(spark):
    ages = [0, 23, 24, 34, 35, 50, 51, 65, 66, None, -1]
    rows = spark.createDataFrame([(a,) for a in ages], "age int")
    out = [r[0] for r in rows.select(survey.age_group()).collect()]
    a, b, c, d, e = AGE_LABELS
    assert out == [a, a, b, b, c, c, d, d, e, None, None]


def test_experience_gaps_fall_into_the_last_class(spark):
    years = [0.5, 1.0, 5.0, 5.5, 6.0, 10.0, 10.5, None]
    rows = spark.createDataFrame([(y,) for y in years], "experience double")
    out = [r[0] for r in rows.select(survey.experience_class()).collect()]
    a, b, c, d = EXPERIENCE_LABELS
    assert out == [a, b, b, d, c, c, d, d]


def test_shares_with_other_bucket_and_absent_label(spark):
    rows = spark.createDataFrame([("Male",), ("Male",), ("Non-binary",), ("Prefer not to say",), (None,)], "sex string")
    assert values(survey.sex_shares(rows), "label", "n", "pct") == [
        ("Female", 0, 0.0), ("Male", 2, 50.0), ("Other", 2, 50.0),
    ]
    assert values(survey.sex_shares(rows.where("sex IS NULL")), "n", "pct") == [(0, 0.0)] * 3


def test_resubmissions_of_an_empty_arm(spark):
    rows = spark.createDataFrame(
        [("AI", 10.0, 4.0), ("AI", 10.0, None), ("AI", None, 3.0)], "arm string, first double, again double"
    )
    table = survey.resubmissions(rows, "arm", ARMS, "first", "again")
    assert values(table) == [("AI", 3, 1, 33.33, -6.0), ("NonAI", 0, 0, 0.0, None)]
    wide = survey.reduction_pivot(table, "arm", ARMS, "S1").first()
    assert (wide["scenario"], wide["AI"], wide["NonAI"]) == ("S1", -6.0, None)


def test_slack_reduction_filters(spark):
    rows = spark.createDataFrame(
        [(20.0, 15.0), (20.0, 9.0), (12.0, 15.0), (None, 15.0), (15.0, 15.0)], "first double, final double"
    )
    out = survey.slack_reduction(rows, "first", "final", forecast=10, relative=True)
    assert values(out, "slack", "reduction", "negative", "relative_reduction") == [
        (5.0, 0.0, 0.0, 0.0), (5.0, 5.0, -5.0, 0.25),
    ]


def test_contingency_keeps_unseen_cells(spark):
    rows = spark.createDataFrame([("Male", "AI"), ("Male", "AI"), ("Other", "AI")], "sex string, arm string")
    out = survey.contingency(rows, "sex", "arm", ["Male", "Female"], ARMS)
    assert values(out, "sex", "AI", "NonAI") == [("Female", 0, 0), ("Male", 2, 0)]


def test_demographics_join_by_key(spark):
    answers = spark.createDataFrame([(1,), (2,), (3,)], "pid int")
    people = spark.createDataFrame([(2, "Male"), (1, "Female"), (9, "Male")], "pid int, sex string")
    out = survey.attach_demographics(answers, people, ["sex"])
    assert values(out) == [(1, "Female"), (2, "Male"), (3, None)]
    assert values(survey.participants_only(people, answers)) == [(1, "Female"), (2, "Male")]
    with pytest.raises(Exception, match="several demographic rows"):
        survey.attach_demographics(answers, people.union(people), ["sex"]).collect()


def test_arm_tables(spark):
    rows = spark.createDataFrame([("AI", 1.0, 1.0), ("AI", 3.0, 2.0)], "arm string, initial double, final double")
    assert values(survey.arm_counts(rows, "arm", ARMS), "arm", "n") == [("AI", 2), ("NonAI", 0)]
    table = survey.arm_distribution(rows, "arm", ARMS, {"initial": "initial", "final": "final"})
    got = {(r["arm"], r["stage"]): (r["count"], r["mean"], r["median"]) for r in table.collect()}
    assert got[("AI", "initial")] == (2, 2.0, 2.0)
    assert got[("AI", "final")] == (2, 1.5, 1.5)
    assert got[("NonAI", "final")] == (0, None, None)


def test_completed(spark):
    rows = spark.createDataFrame([("Yes",), (None,)], "Manip_Check string")
    assert survey.completed(rows).select(F.count("*")).first()[0] == 1


def test_slack_reduction_leaves_failed_checks_out(spark):
    from slackline.plans import queries

    folder = "/root/testdata/sf0.001"
    passed = {r["pid"] for r in queries.answered(spark, folder).collect()}
    kept = {r["pid"] for r in queries.slack_reduction(spark, folder).collect()}
    assert kept and kept <= passed
    assert all(pid % 7 and pid % 5 for pid in kept)
